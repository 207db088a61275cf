"""The condition mini-language and the contrasts that follow from it.

``A`` is a column; ``A:B`` joins the tokens of several with a dot; ``A@B`` runs A within each level of B;
``A^B`` asks for their interaction. ``X_vs_Y`` (or ``X vs Y``) names a contrast.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import composite, level_name


@dataclass(frozen=True)
class Condition:
    factors: tuple[str, ...]
    within: str | None = None
    interaction: str | None = None

    def column(self) -> Column:
        return level_name(F.col(self.factors[0])) if len(self.factors) == 1 else composite(*(F.col(f) for f in self.factors))


def parse(text: str) -> Condition:
    if "^" in text:
        a, _, b = (x.strip() for x in text.partition("^"))
        if not a or not b:
            raise ValueError(f"an interaction needs two columns: {text!r}")
        return Condition((a,), interaction=b)
    main, at, within = (x.strip() for x in text.partition("@"))
    factors = tuple(x.strip() for x in main.split(":"))
    if not all(factors) or at and not within:
        raise ValueError(f"a condition has an empty part: {text!r}")
    return Condition(factors, within or None)


def parse_contrast(text: str) -> tuple[str, str]:
    parts = [x.strip() for x in re.split(r"_vs_|\s+vs\s+", text.strip(), maxsplit=1)]
    if len(parts) != 2 or not all(parts) or parts[0] == parts[1]:
        raise ValueError(f"a contrast is X_vs_Y with different sides: {text!r}")
    return parts[0], parts[1]


def all_pairs(rows: DataFrame, level: str) -> DataFrame:
    """Unordered pairs of levels, the lesser first. Levels are a dimension: the join is of a few rows."""
    levels = rows.select(F.col(level).alias("a")).where("a is not null").distinct()
    return levels.join(F.broadcast(levels.toDF("b")), F.col("a") < F.col("b"))


def versus_reference(rows: DataFrame, level: str, reference: str | None = None) -> DataFrame:
    """Every level against a reference; without one, the most frequent (ties: the first by name)."""
    levels = rows.groupBy(F.col(level).alias("a")).count().where("a is not null")
    if reference is None:
        base = levels.orderBy(F.desc("count"), "a").limit(1).select(F.col("a").alias("b"))
        return levels.crossJoin(F.broadcast(base)).where("a != b").select("a", "b")
    return levels.where(F.col("a") != reference).select("a", F.lit(reference).alias("b"))
