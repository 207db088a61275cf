"""Top-k selections, multi-tier fills, feature selection, sampling and small selection rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import min_max, top_k


def top_genes(table: DataFrame, by: list[str], n: int, alpha: float = 0.05, gene: str = "gene_id", lfc: str = "lfc", padj: str = "padj") -> DataFrame:
    """Significant genes by padj, then by greatest absolute fold change; the first n of each group."""
    return top_k(table.where(F.col(padj) < alpha), n, by, F.col(padj), F.desc(F.abs(lfc)), F.col(gene), rank="rank")


def top_signed(table: DataFrame, by: list[str], n: int, sign: int, alpha: float = 0.05, gene: str = "gene_id", lfc: str = "lfc", padj: str = "padj") -> DataFrame:
    """Genes of one sign: significant ones first, filled up from the others of that sign."""
    mine = table.where(F.signum(lfc) == F.lit(float(sign))).withColumn("significant", F.coalesce(F.col(padj) < alpha, F.lit(False)))
    return top_k(mine, n, by, F.desc("significant"), F.col(padj).asc_nulls_last(), F.desc(F.abs(lfc)), F.col(gene), rank="rank")


def top_enrichment(table: DataFrame, by: list[str], n: int, score: str = "score", padj: str = "padj", name: str = "pathway") -> DataFrame:
    """The first n rows going up and the first n going down, by padj, absolute score, name."""
    side = F.when(F.col(score) > 0, F.lit("up")).when(F.col(score) < 0, F.lit("down"))
    return top_k(table.withColumn("side", side).where("side is not null"), n, [*by, "side"], F.col(padj).asc_nulls_last(), F.desc(F.abs(score)), F.col(name), rank="rank")


def top_features(matrix: DataFrame, feature: str, value: str, k: int, mode: str = "variance") -> DataFrame:
    """Features of the greatest sample variance, or of the greatest absolute mean."""
    score = F.var_samp(value) if mode == "variance" else F.abs(F.avg(value))
    scored = matrix.groupBy(feature).agg(F.round(score, 9).alias("score")).withColumn("_g", F.lit(0))
    return top_k(scored, k, ["_g"], F.desc("score"), F.col(feature), rank="rank").drop("_g")


def balanced_top(matrix: DataFrame, feature: str, value: str, k: int) -> DataFrame:
    """floor(k / 2) features of the greatest positive mean, the rest of the most negative."""
    means = matrix.groupBy(feature).agg(F.round(F.avg(value), 9).alias("mean")).withColumn("_g", F.lit(0))
    high = top_k(means.where("mean > 0"), k // 2, ["_g"], F.desc("mean"), F.col(feature))
    low = top_k(means.where("mean < 0"), k - k // 2, ["_g"], F.col("mean"), F.col(feature))
    return high.unionByName(low).drop("_g")


def stratified(rows: DataFrame, label: str, most: int, seed: str = "0", key: str = "cell_id") -> DataFrame:
    """At most so many rows of each label, without replacement, in order of an md5 of seed and key."""
    return top_k(rows.withColumn("_h", F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))), most, [label], F.col("_h"), F.col(key)).drop("_h")


def two_levels(rows: DataFrame, level: str, a: str, b: str, most: int, seed: str = "0", key: str = "cell_id") -> tuple[DataFrame, DataFrame]:
    """(rows, one row of numbers): at most so many rows of either level, each drawn by itself; 0 draws all."""
    held = rows.where(F.col(level).isin(a, b))
    used = stratified(held, level, most, seed, key) if most > 0 else held
    count = lambda x, name: F.sum((F.col(level) == x).cast("long")).alias(name)
    before = held.agg(count(a, "n_a"), count(b, "n_b"))
    limit = F.lit(most if most > 0 else 1 << 62)
    numbers = before.select("n_a", "n_b", F.least("n_a", limit).alias("n_a_used"), F.least("n_b", limit).alias("n_b_used"))
    return used, numbers.withColumn("downsampled", (F.col("n_a_used") < F.col("n_a")) | (F.col("n_b_used") < F.col("n_b")))


def proportional(rows: DataFrame, batch: str, target: int, seed: str = "0", key: str = "cell_id") -> DataFrame:
    """About ``target`` rows, every batch by its share: the floor of it, one at least if the target has room for all
    batches, and what is left to the greatest remainders (ties: the first by name). Drawn by an md5 of seed and key."""
    sizes = rows.where(F.col(batch).isNotNull()).groupBy(batch).agg(F.count("*").alias("_n"))
    every = Window.partitionBy(F.lit(0))  # batches, not rows
    share = F.col("_n") * F.lit(float(target)) / F.sum("_n").over(every)
    room = F.count("*").over(every) <= target
    base = F.least("_n", F.greatest(F.floor(share), F.when(room, F.lit(1)).otherwise(F.lit(0)))).cast("long")
    given = sizes.withColumn("_share", share).withColumn("_base", base)
    left = F.lit(target) - F.sum("_base").over(every)
    order = Window.partitionBy(F.lit(0)).orderBy((F.col("_base") < F.col("_n")).desc(), F.desc(F.round(F.col("_share") - F.col("_base"), 9)), batch)
    more = given.withColumn("_left", left).withColumn("_k", F.row_number().over(order))
    take = F.col("_base") + F.when((F.col("_k") <= F.col("_left")) & (F.col("_base") < F.col("_n")), 1).otherwise(0)
    hashed = rows.withColumn("_h", F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))).join(F.broadcast(more.select(batch, take.alias("_take"))), batch)
    placed = hashed.withColumn("_r", F.row_number().over(Window.partitionBy(batch).orderBy("_h", key))).where("_r <= _take")
    return placed.select(*rows.columns)


def sort_results(rows: DataFrame, order: list[tuple[str, bool]], tie: list[str]) -> DataFrame:
    """Sorted by columns with their own directions; missing ones are skipped."""
    have = [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in order if c in rows.columns]
    return rows.orderBy(*have, *tie)


def prior_column(columns: list[str], preferred: tuple[str, ...]) -> tuple[str, bool] | None:
    """The first present score column, and whether less of it is better (ranks and p-values)."""
    for name in preferred:
        if name in columns:
            return name, "rank" in name or "pval" in name
    return None


def parsimonious(curve: DataFrame, x: str = "resolution", score: str = "score", share: float = 0.97) -> DataFrame:
    """The least x whose score reaches a share of the best."""
    return curve.crossJoin(F.broadcast(curve.agg(F.max(score).alias("_best")))).where(F.col(score) >= share * F.col("_best")).agg(F.min(x).alias(x))


def plateaus(curve: DataFrame, x: str, good: Column, least: int = 3, value: str = "stability") -> DataFrame:
    """Runs of neighbouring x (gaps and islands) that are all good and long enough."""
    order = Window.partitionBy(F.lit(0)).orderBy(x)
    flagged = curve.withColumn("_good", F.coalesce(good, F.lit(False)))
    island = flagged.withColumn("_i", F.sum((~F.col("_good")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))).where("_good")
    return island.groupBy("_i").agg(F.min(x).alias("start"), F.max(x).alias("end"), F.count("*").alias("length"), F.avg(value).alias("mean")).where(F.col("length") >= least).drop("_i")


def explained_components(variance: DataFrame, share: float = 0.85, low: int = 20, high: int = 50) -> DataFrame:
    """The first component at which the cumulative share is reached, within bounds."""
    order = Window.partitionBy(F.lit(0)).orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    reached = variance.withColumn("_c", F.sum("share").over(order)).agg(F.min(F.when(F.col("_c") >= share, F.col("component"))).alias("_k"), F.max("component").alias("_m"))
    return reached.select(F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce("_k", "_m"))).cast("long").alias("n_components"))


def best_embedding(metrics: DataFrame, baseline: str) -> DataFrame:
    """Of embeddings (name, bio, batch, total): those better than the baseline in both, else in bio, else in
    batch, else any; the greatest total, ties by name."""
    base = metrics.where(F.col("name") == baseline).select(F.col("bio").alias("_bio"), F.col("batch").alias("_batch"))
    bio, batch = F.col("bio") > F.col("_bio"), F.col("batch") > F.col("_batch")
    tier = F.when(bio & batch, 0).when(bio, 1).when(batch, 2).otherwise(3)
    return metrics.crossJoin(F.broadcast(base)).withColumn("tier", tier).orderBy("tier", F.desc("total"), "name").limit(1).select("name", "tier", "total")


def selection_scores(curve: DataFrame, weights: dict[str, float], x: str = "resolution") -> DataFrame:
    """Weighted sum of min-max scaled measures of a curve."""
    every = Window.partitionBy(F.lit(0))
    return curve.withColumn("score", sum((w * min_max(F.col(c), every) for c, w in weights.items()), F.lit(0.0))).orderBy(x)
