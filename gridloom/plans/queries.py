"""All queries and their DuckDB texts."""

from __future__ import annotations

from . import design_queries, kernel_queries, merge_queries, network_queries, qc_queries, signal_queries, stat_queries, task_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
