"""Entry points on datasets: thin compositions of the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .model import Dataset
from .operators import enrichment, merge, pseudobulk, qc, rounds
from .sources.files import load_dataset, read_gmt, read_modules, read_result_folder, save_dataset
from .sources.lineage import materialise

__all__ = ["add_obs_metadata", "enrichment_cluster", "enrichment_de_from_tables", "load_and_filter", "load_dataset", "merge_datasets", "module_score", "rename_idents", "save_dataset", "subset_by_cluster_mapping"]


def load_and_filter(data: Dataset, subsets: dict, *, sample: str = "sample_id", min_cells: int = 3, least_cells: int = 20, **cuts) -> tuple[Dataset, DataFrame]:
    """Metrics, the cascade, small samples out, rare genes out: the filtered dataset and the judged cells."""
    cells = qc.cell_metrics(data.layer(), data.obs, subsets, (sample,))
    judged = qc.cascade(cells, [sample], **cuts)
    kept = qc.large_groups(judged.where("failed_at is null"), sample, least_cells)
    out = data.subset(kept)
    genes = out.layer().groupBy("gene_id").agg(F.count("*").alias("n")).where(F.col("n") >= min_cells).select("gene_id")
    return Dataset(out.obs.join(kept.drop(sample, "failed_at"), "cell_id"), out.var.join(genes, "gene_id", "left_semi"), out.counts.join(genes, "gene_id", "left_semi"), out.tables), judged


def add_obs_metadata(data: Dataset, metadata: DataFrame, metadata_key: str, obs_key: str = "sample_id", **rules) -> Dataset:
    return Dataset(merge.add_metadata(data.obs, metadata, obs_key, metadata_key, **rules), data.var, data.counts, data.tables)


def rename_idents(data: Dataset, mapping: DataFrame, label: str) -> Dataset:
    """Labels renamed by cluster code and numbered anew by size."""
    named = merge.rename(data.obs, mapping, label)
    shown = rounds.display(named.select("cell_id", F.col(label).alias("cluster_id")))
    return Dataset(named, data.var, data.counts, data.tables | {"round_display": shown})


def subset_by_cluster_mapping(data: Dataset, mapping: DataFrame, label: str) -> dict[str, Dataset]:
    marked = merge.subset_by_clusters(data.obs, mapping, label)
    names = sorted(r["subset"] for r in mapping.select("subset").distinct().collect())
    return {name: data.subset(marked.where(F.col("subset") == name)) for name in names}


def merge_datasets(parts: dict[str, Dataset], how: str = "outer") -> Dataset:
    """Datasets with prefixed cell ids and a dataset column; genes united or intersected."""
    named = {n: Dataset(d.obs.withColumn("cell_id", F.concat_ws("__", F.lit(n), F.col("cell_id"))).withColumn("dataset", F.lit(n)), d.var, d.counts.withColumn("cell_id", F.concat_ws("__", F.lit(n), F.col("cell_id"))).withColumn("dataset", F.lit(n))) for n, d in parts.items()}
    obs = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (d.obs for d in named.values()))
    counts = reduce(DataFrame.unionByName, (d.counts for d in named.values()))
    if how == "inner":
        shared = counts.select("dataset", "gene_id").distinct().groupBy("gene_id").count().where(F.col("count") == len(parts)).select("gene_id")
        counts = counts.join(shared, "gene_id", "left_semi")
    var = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (d.var for d in named.values())).dropDuplicates(["gene_id"])
    return Dataset(obs, var, counts.drop("dataset"))


def enrichment_cluster(data: Dataset, group: str, gmt: str, method: str = "ulm", least: int = 5) -> DataFrame:
    """Activities of gene sets on the groups' mean expression."""
    means = pseudobulk.means(data.layer(), data.obs, group).select(group, "gene_id", F.col("mean").alias("value"))
    grid = means.select(group).distinct().crossJoin(F.broadcast(data.var.select("gene_id")))
    dense = grid.join(means, [group, "gene_id"], "left").withColumn("value", F.coalesce("value", F.lit(0.0)))
    net = enrichment.prepare(read_gmt(data.obs.sparkSession, gmt), data.var, least)
    scores = {"ulm": enrichment.univariate, "wsum": enrichment.weighted_sum}[method](dense, net, group)
    return scores.withColumn("family", enrichment.family(F.col("source")))


def enrichment_de_from_tables(spark, folder: str, gmt: str, stats: tuple[str, ...] = ("stat", "log2FoldChange", "score"), least: int = 5) -> DataFrame:
    """Activities from a folder of result tables: the first available statistic, missing genes as 0."""
    tables = read_result_folder(spark, folder)
    numbers = tables.select("cluster", "gene", *(F.expr(f"try_cast(`{c}` as double)").alias(c) for c in stats if c in tables.columns))
    matrix = pseudobulk.stat_matrix(numbers, "cluster", "gene", list(stats)).select("cluster", F.col("gene").alias("gene_id"), F.col("stat").alias("value"))
    net = enrichment.prepare(read_gmt(spark, gmt), matrix.select("gene_id").distinct(), least)
    return enrichment.univariate(matrix, net, "cluster")


def module_score(data: Dataset, modules: str, group: str, **options) -> tuple[DataFrame, DataFrame]:
    """Scores per cell of every module of a file, and their summary by group."""
    rows = materialise(read_modules(data.obs.sparkSession, modules))
    names = sorted(r["source"] for r in rows.select("source").distinct().collect())  # modules are a dimension
    long = enrichment.module_scores(qc.lognorm(data.layer()), data.obs, rows, **options)
    wide = long.groupBy("cell_id").pivot("source", names).agg(F.first("score"))
    scored = data.obs.select("cell_id", group).join(wide, "cell_id")
    return scored, pseudobulk.score_summary(scored, group, names)
