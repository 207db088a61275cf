"""Joins with keys that a large part of the rows hold.

A key with many rows is cut into parts: its rows are dealt to the parts by a hash of themselves, and the other
side's row of that key is sent to each part. Which keys those are is a table of fewer than ``MOST_KEYS`` rows
whatever the data, as a key is cut only if it has more than ``max(LEAST_ROWS, rows / MOST_KEYS)`` rows; it is found
first and, where there is none, the join is a plain one. The result is the same.

Both sides grow with the data, so the joins are sort-merge joins at every size: what is measured on little data is the
plan that runs on much.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_ROWS = 256
MOST_KEYS = 1 << 10


def heavy_keys(frame: DataFrame, on: str, total: int | None = None) -> DataFrame | None:
    """(on, _parts) of the keys with many rows, nulls among them, or None if no key has. ``frame`` is read twice, three
    times unless ``total``, its rows, is given: a written table."""
    least = max(LEAST_ROWS, (frame.count() if total is None else total) // MOST_KEYS)
    found = frame.groupBy(on).agg(F.count("*").alias("_n")).where(F.col("_n") > least).select(on, F.ceil(F.col("_n") / least).cast("int").alias("_parts"))
    rows = found.collect()  # fewer than MOST_KEYS
    return frame.sparkSession.createDataFrame(rows, found.schema) if rows else None


def spread_join(many: DataFrame, few: DataFrame, on: str, heavy: DataFrame | None, how: str = "inner", by: str | None = None) -> DataFrame:
    """``many.join(few, on, how)`` (inner, left or left_semi), the heavy keys' rows of ``many`` in parts of bounded
    size. Rows with a null key match nothing and are dealt too. ``by`` names the column that deals rows to parts; else
    all do."""
    if heavy is None:
        return many.join(few.hint("merge"), on, how)
    heavy = F.broadcast(heavy)
    place = F.xxhash64(*([by] if by else many.columns))
    part = F.when(F.col(on).isNull(), F.pmod(place, F.lit(MOST_KEYS)).cast("int")).otherwise(F.coalesce(F.pmod(place, F.col("_parts")).cast("int"), F.lit(0)))
    left = many.join(heavy, on, "left").withColumn("_part", part).drop("_parts")
    right = few.join(heavy, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))).drop("_parts")
    return left.join(right.hint("merge"), [on, "_part"], how).drop("_part")
