"""Connected components of a link table by alternating large and small stars (Kiveris and others, 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hot import heavy_keys, spread_join
from .scratch import shared_folder


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame, total: int) -> DataFrame:
    """Links every greater neighbour of a node to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
    met = spread_join(both, least, "a", heavy_keys(both, "a", 2 * total))
    return met.where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b")).where("a != b").distinct()


def _small(edges: DataFrame, total: int) -> DataFrame:
    """Links a node and its smaller neighbours to the least of these. Edges point from greater to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("root"))
    across = spread_join(edges, least, "a", heavy_keys(edges, "a", total)).select(F.col("b").alias("a"), F.col("root").alias("b"))
    return across.unionByName(least.select("a", F.col("root").alias("b"))).where("a != b").distinct()


def connect(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) for every node of a link table (a, b); the root is the component's least node.

    The stars' groups are only aggregated and joined, never gathered; each round's lineage is cut in the
    shared checkpoint folder. An empty table has no nodes.
    """
    shared_folder(links.sparkSession)
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct().checkpoint()
    before = _state(edges)
    for _ in range(rounds):
        edges = _large(edges, before[0]).checkpoint()
        edges = _small(edges, edges.count()).checkpoint()
        now = _state(edges)
        if now == before:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        before = now
    raise RuntimeError(f"no fixed point in {rounds} rounds")
