"""Composition of samples: centred log ratios with rank tests for all pairs of levels, and neighbourhood tests with
simpler models where the first one can't be fitted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import benjamini_hochberg, weighted_benjamini_hochberg
from . import kernels
from .ranktests import shrink

EPS = 1e-6


def centred_log_ratios(table: DataFrame, sample: str, cluster: str) -> DataFrame:
    """``table`` (sample, cluster, n, ...) on the full grid with share and clr: log(share + 1e-6) less its mean over the
    sample's clusters. Samples without cells have nulls."""
    by = Window.partitionBy(sample)
    shared = table.withColumn("share", F.try_divide(F.col("n").cast("double"), F.sum("n").over(by)))
    return shared.withColumn("_l", F.log(F.col("share") + EPS)).withColumn("clr", F.col("_l") - F.avg("_l").over(by)).drop("_l")


def clr_mann_whitney(table: DataFrame, sample: str, cluster: str, condition: str) -> DataFrame:
    """Per cluster and pair of levels (ref before test, in string order): log2 fold change of the mean shares, both mean
    ratios, the rank test of the ratios, and fdr by pair."""
    ratios = centred_log_ratios(table, sample, cluster).where(F.col(condition).isNotNull() & F.col("clr").isNotNull())
    levels = ratios.select(F.col(condition).alias("level_ref")).distinct()
    pairs = levels.join(F.broadcast(levels.toDF("level_test")), F.col("level_ref") < F.col("level_test"))  # levels are a few
    rows = ratios.select(sample, F.col(cluster).alias("cluster"), F.col(condition).alias("_level"), "share", "clr").join(F.broadcast(pairs), (F.col("_level") == F.col("level_ref")) | (F.col("_level") == F.col("level_test")))
    rows = rows.withColumn("side", F.when(F.col("_level") == F.col("level_ref"), "ref").otherwise("test"))
    by = ["cluster", "level_ref", "level_test"]
    of = lambda f, c, side: f(F.when(F.col("side") == side, F.col(c)))
    stats = rows.groupBy(*by).agg(of(F.avg, "clr", "ref").alias("clr_mean_ref"), of(F.avg, "clr", "test").alias("clr_mean_test"), F.log2((of(F.avg, "share", "test") + EPS) / (of(F.avg, "share", "ref") + EPS)).alias("log2fc"))
    tests = kernels.mann_whitney_by(rows, by, "side", "clr", "ref", "test", 1).select(*by, "pval")
    return benjamini_hochberg(stats.join(tests, by), "pval", ("level_ref", "level_test"), out="fdr", tie=("cluster",))


def support(table: DataFrame, unit: str, condition: str) -> DataFrame:
    """Per unit: samples with a member, the least number of these over levels, and in all."""
    per = table.groupBy(unit, condition).agg(F.sum((F.col("n") > 0).cast("long")).alias("_k"))
    return per.groupBy(unit).agg(F.min("_k").alias("min_nonzero_per_level"), F.sum("_k").alias("n_nonzero_total"))


def neighbourhood_test(table: DataFrame, radius: DataFrame, sample: str, reference: str, *, k: float = 10.0, models: tuple[str, ...] = ("negbin", "binomial", "clr")) -> DataFrame:
    """Abundance of neighbourhoods (seed, sample, condition, n, total) by the first of the models that gives any row:
    negative binomial, else binomial, else rank tests of log ratios. P-values weighted by 1 / radius within each term,
    effects shrunk by the samples that support them; ``model`` says which it was."""
    named = table.select(F.col("seed").cast("string").alias("cluster"), sample, F.col("condition").cast("string").alias("condition"), "n", "total")
    fits = None
    for model in models:
        if model == "clr":
            found = clr_mann_whitney(named, sample, "cluster", "condition").select("cluster", F.concat_ws("_vs_", "level_ref", "level_test").alias("term"), F.col("log2fc").alias("effect"), "pval")
        else:
            found = kernels.composition_glm(named, reference, model).select("cluster", "term", "effect", "pval")
        fits = found.withColumn("model", F.lit(model))
        if fits.limit(1).count():
            break
    held = support(named, "cluster", "condition")
    weights = radius.select(F.col("seed").cast("string").alias("cluster"), (1.0 / F.greatest("radius", F.lit(1e-8))).alias("weight"))
    met = fits.join(held, "cluster").join(weights, "cluster")
    plain = benjamini_hochberg(met, "pval", ("term",), out="fdr_bh", tie=("cluster",))
    return weighted_benjamini_hochberg(plain, "pval", "weight", ("term",), out="fdr", tie=("cluster",)).withColumn("effect_shrunk", shrink(F.col("effect"), F.col("n_nonzero_total"), k))
