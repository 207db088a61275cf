"""The registry of queries: a name, a plan over the views, and the DuckDB text it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import Views, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable:
    """Registers a plan; without an oracle only its rows are checked, for the reason its docstring gives."""

    def register(plan: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        QUERIES[name] = lambda spark, folder: plan(Views(spark, folder))
        if oracle is not None:
            ORACLES[name] = sql(oracle)
        return plan

    return register
