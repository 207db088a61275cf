"""Pseudobulk sums, means and medians with implicit zeros, effects, crosstabs and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import clip, z_population


def aggregate(counts: DataFrame, obs: DataFrame, sample: str, group: str, least_cells: int = 1) -> DataFrame:
    """Per (sample, group, gene): the sum, with the library's cells (from obs, not from triples) and id."""
    sizes = obs.groupBy(sample, group).agg(F.count("*").alias("n_cells")).where(F.col("n_cells") >= least_cells)
    summed = counts.join(obs.select("cell_id", sample, group), "cell_id").groupBy(sample, group, "gene_id").agg(F.sum("value").alias("value"))
    return summed.join(sizes, [sample, group]).withColumn("library", F.concat_ws("|", F.col(sample).cast("string"), F.col(group).cast("string")))


def means(layer: DataFrame, obs: DataFrame, group: str) -> DataFrame:
    """Mean per (group, gene) over all cells of the group, zeros included."""
    sizes = obs.groupBy(group).agg(F.count("*").alias("n_cells"))
    return layer.join(obs.select("cell_id", group), "cell_id").groupBy(group, "gene_id").agg(F.sum("value").alias("_s"), F.count("*").alias("n_expr")).join(sizes, group).select(group, "gene_id", (F.col("_s") / F.col("n_cells")).alias("mean"), (F.col("n_expr") / F.col("n_cells")).alias("fraction"))


def medians(layer: DataFrame, obs: DataFrame, group: str) -> DataFrame:
    """Median per (group, gene) over all cells, zeros included: the ranks of stored (positive) values are
    shifted by the number of zeros instead of writing these out."""
    sizes = obs.groupBy(group).agg(F.count("*").alias("n"))
    met = layer.join(obs.select("cell_id", group), "cell_id").join(F.broadcast(sizes), group)
    ranked = met.withColumn("_r", F.row_number().over(Window.partitionBy(group, "gene_id").orderBy("value")) + F.col("n") - F.count("*").over(Window.partitionBy(group, "gene_id")))
    low, high = F.floor((F.col("n") + 1) / 2), F.floor((F.col("n") + 2) / 2)
    return ranked.groupBy(group, "gene_id").agg(((F.sum(F.when(F.col("_r") == low, F.col("value")).otherwise(0.0)) + F.sum(F.when(F.col("_r") == high, F.col("value")).otherwise(0.0))) / 2).alias("median"))


def effect(pseudobulk: DataFrame, level: str, a: str, b: str, *, pseudocount: float = 1.0, min_total: float = 10.0) -> DataFrame:
    """log2((A + pc) / (B + pc)) per gene with at least ``min_total`` in all, and counts per million over kept genes."""
    sides = pseudobulk.where(F.col(level).isin(a, b)).groupBy("gene_id").agg(*(F.sum(F.when(F.col(level) == x, F.col("value")).otherwise(0.0)).alias(n) for x, n in ((a, "sum_a"), (b, "sum_b")))).where(F.col("sum_a") + F.col("sum_b") >= min_total)
    every = Window.partitionBy(F.lit(0))
    return sides.select("gene_id", "sum_a", "sum_b", F.log2((F.col("sum_a") + pseudocount) / (F.col("sum_b") + pseudocount)).alias("log2fc"), *((F.try_divide(F.col(f"sum_{n}") * 1e6, F.sum(f"sum_{n}").over(every))).alias(f"cpm_{n}") for n in "ab"))


def target_vs_rest(pseudobulk: DataFrame, sample: str, group: str, target: str) -> DataFrame:
    """Paired libraries per sample and gene: the target's sum and the sample's rest, never below 0."""
    both = pseudobulk.groupBy(sample, "gene_id").agg(F.sum("value").alias("_t"), F.sum(F.when(F.col(group) == target, F.col("value")).otherwise(0.0)).alias("_x"))
    return both.select(sample, "gene_id", F.stack(F.lit(2), F.lit("target"), F.col("_x"), F.lit("rest"), F.greatest(F.col("_t") - F.col("_x"), F.lit(0.0))).alias("side", "value"))


def crosstab(obs: DataFrame, sample: str, group: str) -> DataFrame:
    """Cells per (sample, group), pairs without a cell as 0, and the share in the sample."""
    grid = obs.select(sample).distinct().crossJoin(F.broadcast(obs.select(group).distinct()))  # dimension by dimension
    n = obs.groupBy(sample, group).agg(F.count("*").alias("n"))
    full = grid.join(n, [sample, group], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    return full.withColumn("share", F.try_divide(F.col("n"), F.sum("n").over(Window.partitionBy(sample))))


def stable_reference(table: DataFrame, group: str, min_mean: float) -> DataFrame:
    """One row: the group of the least MAD of shares among those of mean share >= min_mean, else the most abundant."""
    middle = table.groupBy(group).agg(F.median("share").alias("_m"), F.avg("share").alias("mean_share"))
    spread = table.join(F.broadcast(middle), group).groupBy(group).agg(F.median(F.abs(F.col("share") - F.col("_m"))).alias("mad"), F.first("mean_share").alias("mean_share"))
    fits = F.col("mean_share") >= min_mean
    return spread.orderBy(F.desc(fits), F.when(fits, F.round("mad", 9)).otherwise(-F.round("mean_share", 9)), group).limit(1).select(F.col(group).alias("reference"), "mad", "mean_share")


def covariates(obs: DataFrame, sample: str, names: list[str], order: str = "cell_id") -> DataFrame:
    """Per sample the first non-null value of each covariate and how many different ones it has."""
    return obs.groupBy(sample).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in names), *(F.countDistinct(c).alias(f"n_{c}") for c in names))


def require_samples(obs: DataFrame, sample: str, condition: str, least: int) -> DataFrame:
    """Samples per level; raises if a level has fewer than ``least``."""
    n = obs.groupBy(condition).agg(F.countDistinct(sample).alias("n_samples"))
    if n.where(F.col("n_samples") < least).limit(1).count():
        raise ValueError(f"a level of {condition} has fewer than {least} samples")
    return n


def majority(cells: DataFrame, cluster: str, label: str, mask: str | None = None, least: int = 25, share: float = 0.1, unknown: str = "Unknown") -> DataFrame:
    """Per cluster the commonest label of its masked cells (ties: the first by name); too few give ``unknown``."""
    use = F.col(mask) if mask else F.lit(True)
    n = cells.groupBy(cluster).agg(F.count("*").alias("n_cells"), F.sum(use.cast("long")).alias("n_masked"))
    top = cells.where(use).groupBy(cluster, label).count().groupBy(cluster).agg(F.min_by(label, F.struct(-F.col("count"), F.col(label))).alias("_top"))
    few = (F.col("n_masked") < least) | (F.col("n_masked") < share * F.col("n_cells")) | F.col("_top").isNull()
    return n.join(top, cluster, "left").select(cluster, "n_cells", "n_masked", F.when(few, F.lit(unknown)).otherwise(F.col("_top")).alias("label"))


def flow(cells: DataFrame, a: str, b: str, min_share: float = 0.0) -> DataFrame:
    """Cells per pair of labels and their share of the first label's."""
    n = cells.groupBy(a, b).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(a))).where(F.col("share") >= min_share)


def stat_matrix(tables: DataFrame, cluster: str, gene: str, preferred: list[str]) -> DataFrame:
    """Per (cluster, gene) of the full grid: the first available statistic, duplicates averaged, missing as 0."""
    value = F.coalesce(*(F.col(c) for c in preferred if c in tables.columns))
    known = tables.groupBy(cluster, gene).agg(F.avg(value).alias("stat"))
    grid = known.select(cluster).distinct().crossJoin(F.broadcast(known.select(gene).distinct()))
    return grid.join(known, [cluster, gene], "left").withColumn("stat", F.coalesce("stat", F.lit(0.0)))


def heatmap(layer: DataFrame, obs: DataFrame, sample: str, limit: float = 3.0) -> DataFrame:
    """Mean per (sample, gene) over all cells, as population z-scores of the gene, clipped."""
    grid = means(layer, obs, sample)
    return grid.withColumn("z", clip(z_population(F.col("mean"), Window.partitionBy("gene_id")), -limit, limit)).select(sample, "gene_id", "mean", "z")


def score_summary(scores: DataFrame, group: str, names: list[str]) -> DataFrame:
    """Per (group, score): mean, median, cells, and the mean's population z-score over groups."""
    long = scores.select(group, F.explode(F.array(*(F.struct(F.lit(n).alias("module"), F.col(n).cast("double").alias("score")) for n in names))).alias("x")).select(group, "x.*")
    stats = long.groupBy(group, "module").agg(F.avg("score").alias("mean"), F.median("score").alias("median"), F.count("*").alias("n_cells"))
    return stats.withColumn("z", z_population(F.col("mean"), Window.partitionBy("module")))
