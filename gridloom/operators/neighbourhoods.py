"""Neighbourhood abundance: seeds, members, counts by sample, a model per neighbourhood, adjusted by weight."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import weighted_benjamini_hochberg
from . import kernels
from .ranktests import shrink


def seeds(cells: DataFrame, cluster: str, n_random: int, least: int, seed: str = "0") -> DataFrame:
    """One seed per cluster of at least ``least`` cells, and further ones, all in order of an md5 of seed and id."""
    h = F.md5(F.concat_ws("|", F.lit(seed), F.col("cell_id").cast("string")))
    by = Window.partitionBy(cluster)
    marked = cells.withColumn("_h", h).withColumn("_r", F.row_number().over(by.orderBy("_h", "cell_id"))).withColumn("_n", F.count("*").over(by))
    first = marked.where((F.col("_r") == 1) & (F.col("_n") >= least))
    more = marked.join(first.select("cell_id"), "cell_id", "left_anti").orderBy("_h", "cell_id").limit(n_random)
    return first.unionByName(more).drop("_h", "_r", "_n")


def neighbourhoods(cells: DataFrame, picked: DataFrame, k: int) -> DataFrame:
    """(seed, cell_id, distance): the k + 1 cells nearest to each seed, itself among them."""
    return kernels.nearest(cells, picked, k + 1).select(F.col("query").alias("seed"), F.col("neighbour").alias("cell_id"), "distance", "place")


def abundance(members: DataFrame, obs: DataFrame, sample: str, condition: str, least_nonzero: int = 3) -> DataFrame:
    """Members per (seed, sample) with the sample's cells, for seeds that enough samples of every level support."""
    totals = obs.groupBy(sample).agg(F.first(condition).alias("condition"), F.count("*").alias("total"))
    n = members.join(obs.select("cell_id", sample), "cell_id").groupBy("seed", sample).agg(F.count("*").alias("n"))
    grid = members.select("seed").distinct().crossJoin(F.broadcast(totals)).join(n, ["seed", sample], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    levels = totals.select("condition").distinct().count()
    ok = grid.groupBy("seed", "condition").agg(F.sum((F.col("n") > 0).cast("long")).alias("_k")).where(F.col("_k") >= least_nonzero).groupBy("seed").count().where(F.col("count") == levels).select("seed")
    return grid.join(F.broadcast(ok), "seed", "left_semi")


def differential(table: DataFrame, radius: DataFrame, reference: str, k: float = 10.0) -> DataFrame:
    """Negative binomial per neighbourhood, p-values weighted by 1 / radius within each term, shrunk effects."""
    named = table.select(F.col("seed").cast("string").alias("cluster"), F.col("condition").cast("string").alias("condition"), "n", "total")
    fits = kernels.composition_glm(named, reference, "negbin")
    members = named.groupBy("cluster").agg(F.sum("n").alias("n_cells"))
    met = fits.join(F.broadcast(radius.select(F.col("seed").cast("string").alias("cluster"), (1.0 / F.greatest("radius", F.lit(1e-12))).alias("weight"))), "cluster").join(F.broadcast(members), "cluster")
    return weighted_benjamini_hochberg(met, "pval", "weight", ("term",), tie=("cluster",)).withColumn("shrunk", shrink(F.col("effect"), F.col("n_cells"), k))
