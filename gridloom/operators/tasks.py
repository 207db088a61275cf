"""Task tables of contrasts, column aliases, and small derived labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import benjamini_hochberg
from .kernels import mann_whitney_by


def contrast_tasks(obs: DataFrame, cluster: str, level: str, pairs: DataFrame, least: int = 50) -> DataFrame:
    """One row per (cluster, a, b): cells on both sides, and the reason a task is skipped for."""
    n = obs.groupBy(cluster, level).agg(F.count("*").alias("n"))
    side = lambda name: F.broadcast(n.select(F.col(cluster), F.col(level).alias(name), F.col("n").alias(f"n_{name}")))
    grid = obs.select(cluster).distinct().crossJoin(F.broadcast(pairs))  # clusters x contrasts
    met = grid.join(side("a"), [cluster, "a"], "left").join(side("b"), [cluster, "b"], "left")
    a, b = F.coalesce("n_a", F.lit(0)), F.coalesce("n_b", F.lit(0))
    reason = F.when((a == 0) | (b == 0), "level_absent").when((a < least) | (b < least), "too_few_cells")
    return met.select(cluster, "a", "b", a.cast("long").alias("n_a"), b.cast("long").alias("n_b"), reason.alias("skip_reason"))


def standardise(rows: DataFrame, aliases: dict[str, tuple[str, ...]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns under one name each: the first alias that the rows have, null where there is none."""
    def pick(names: tuple[str, ...]):
        have = [F.col(n) for n in names if n in rows.columns]
        return F.coalesce(*have) if have else F.lit(None)

    return rows.select(*keep, *(pick(names).alias(target) for target, names in aliases.items()))


def supervision(cells: DataFrame, label: str, confident: str, unknown: str = "Unknown") -> DataFrame:
    """The label where it is confident, else ``unknown``."""
    return cells.withColumn(label, F.when(F.coalesce(F.col(confident), F.lit(False)), F.col(label)).otherwise(F.lit(unknown)))


def library_prevalence(libraries: DataFrame, counts: DataFrame, level: str, least: float) -> DataFrame:
    """Per (level, gene) the share of libraries with a count, those without one included; at least ``least``."""
    sizes = libraries.groupBy(level).agg(F.count("*").alias("_n"))
    on = counts.where("value > 0").join(libraries, "library").groupBy(level, "gene_id").agg(F.count("*").alias("_k"))
    return on.join(F.broadcast(sizes), level).select(level, "gene_id", (F.col("_k") / F.col("_n")).alias("share")).where(F.col("share") >= least)


def paired_effects(scored: DataFrame, by: list[str], side: str, value: str, a: str, b: str, least: int = 2) -> DataFrame:
    """Per group of ``by``: numbers, means and medians of both sides, their difference, and Mann-Whitney p-values
    adjusted over all groups. Groups short of values on a side go."""
    kept = scored.where(F.col(side).isin(a, b) & F.col(value).isNotNull())
    of = lambda f, s: f(F.when(F.col(side) == s, F.col(value)))
    stats = kept.groupBy(*by).agg(of(F.avg, a).alias("mean_a"), of(F.avg, b).alias("mean_b"), of(F.median, a).alias("median_a"), of(F.median, b).alias("median_b"))
    tests = mann_whitney_by(kept, by, side, value, a, b, least)
    return benjamini_hochberg(stats.join(tests, by).withColumn("delta", F.col("mean_a") - F.col("mean_b")), "pval", (), tie=tuple(by))


def receiver_genes(tests: DataFrame, context: str, alpha: float, least_gap: float) -> DataFrame:
    """Genes that respond in a receiver: significant after adjustment, with a prevalence gap."""
    adjusted = benjamini_hochberg(tests, "pval", (context,), tie=("gene_id",))
    return adjusted.where((F.col("padj") <= alpha) & (F.abs(F.col("pct_a") - F.col("pct_b")) >= least_gap))


def order_of(rows: DataFrame, *columns: str) -> DataFrame:
    """A categorical's order as an explicit column, from 0."""
    return rows.withColumn("ord", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*columns)) - 1)
