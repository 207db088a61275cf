"""Validated joins, merges of datasets, relabelling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import cluster_code, code_of_rank


def key_report(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: keys on one side only, and repeated keys on the right. All counts, one pass a side."""
    a = left.select(key).distinct().withColumn("_l", F.lit(1))
    b = right.groupBy(key).agg(F.count("*").alias("_r"))
    met = a.join(b, key, "full_outer")
    return met.agg(F.sum(F.col("_r").isNull().cast("long")).alias("missing_metadata"), F.sum(F.col("_l").isNull().cast("long")).alias("unused_metadata"), F.sum((F.coalesce("_r", F.lit(0)) > 1).cast("long")).alias("repeated_keys"))


#: Names that mean the cells' own ids.
CELL_KEYS = ("obs_names", "obs_name", "index", "cell_id", "barcode_id")


def resolve_key(columns: list[str], key: str) -> str:
    """The column that a key means: itself, or for one of the cells' ids, in any case, ``cell_id``."""
    if key in columns:
        return key
    if key.strip().lower() in CELL_KEYS and "cell_id" in columns:
        return "cell_id"
    raise KeyError(f"no column {key!r} among {sorted(columns)[:20]}")


def add_metadata(obs: DataFrame, metadata: DataFrame, obs_key: str, metadata_key: str, *, exact: bool = True, allow_missing: bool = False, overwrite: bool = False) -> DataFrame:
    """Validated left join of columns: unique right keys always; key sets that match both ways if ``exact``;
    no nulls after the join unless ``allow_missing``; existing columns only with ``overwrite``."""
    obs_key = resolve_key(obs.columns, obs_key)
    columns = [c for c in metadata.columns if c != metadata_key]
    taken = [c for c in columns if c in obs.columns]
    if taken and not overwrite:
        raise ValueError(f"columns exist already: {taken}")
    side = metadata.withColumnRenamed(metadata_key, "_key")
    found = key_report(obs.select(F.col(obs_key).alias("_key")), side, "_key").first()
    if found["repeated_keys"]:
        raise ValueError(f"{found['repeated_keys']} metadata keys are repeated")
    if exact and (found["missing_metadata"] or found["unused_metadata"]):
        raise ValueError(f"keys don't match: {found['missing_metadata']} without metadata, {found['unused_metadata']} unused")
    met = obs.drop(*taken).join(side, F.col(obs_key) == F.col("_key"), "left").drop("_key")
    if not allow_missing and columns:
        empty = met.where(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))).limit(1).count()
        if empty:
            raise ValueError("metadata is null for some rows")
    return met


def merge_counts(parts: dict[str, DataFrame], how: str = "outer", separator: str = "__") -> DataFrame:
    """Triples of several datasets with prefixed cell ids; zeros stay implicit. ``inner`` keeps genes that all have."""
    named = [rows.select(F.lit(name).alias("dataset"), F.concat_ws(separator, F.lit(name), F.col("cell_id").cast("string")).alias("cell_id"), "gene_id", "value") for name, rows in parts.items()]
    merged = reduce(DataFrame.unionByName, named)
    if how == "outer":
        return merged
    shared = merged.select("dataset", "gene_id").distinct().groupBy("gene_id").count().where(F.col("count") == len(parts)).select("gene_id")
    return merged.join(shared, "gene_id", "left_semi")


def merge_var(parts: dict[str, DataFrame], fills: dict[str, object]) -> DataFrame:
    """The union of genes, sorted by id, with typed fills for genes that a dataset doesn't describe."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts.values())
    columns = [c for c in merged.columns if c != "gene_id"]
    picked = merged.groupBy("gene_id").agg(*(F.min(c).alias(c) for c in columns))
    return picked.select("gene_id", *(F.coalesce(c, F.lit(fills.get(c))).alias(c) for c in columns)).orderBy("gene_id")


def relabel_by_size(cells: DataFrame, label: str) -> DataFrame:
    """Adds cluster_id (rank by size descending, label ascending, from 0), its Cnn code and display label."""
    sizes = cells.groupBy(label).agg(F.count("*").alias("n_cells"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("n_cells"), F.col(label))
    ranked = sizes.withColumn("cluster_rank", (F.row_number().over(order) - 1).cast("long"))
    code = code_of_rank(F.col("cluster_rank"))
    return ranked.select(label, "n_cells", "cluster_rank", code.alias("code"), F.concat(code, F.lit(": "), F.col(label).cast("string")).alias("display"))


def resolve_tokens(tokens: DataFrame, display: DataFrame) -> DataFrame:
    """Tokens to clusters: by id, else by exact label, else by the Cnn code in a label; ``n_matches`` tells
    unknown (0) and ambiguous (over 1) ones apart."""
    ways = [(0, F.col("token") == F.col("cluster").cast("string")), (1, F.col("token") == F.col("label")), (2, F.col("token") == cluster_code(F.col("label")))]
    way = F.coalesce(*(F.when(rule, F.lit(k)) for k, rule in ways))
    met = tokens.join(F.broadcast(display), reduce(lambda a, b: a | b, (rule for _, rule in ways)), "left").withColumn("way", way)
    best = met.withColumn("_best", F.min("way").over(Window.partitionBy("token"))).where("way <=> _best")
    return best.groupBy("token").agg(F.min("way").alias("way"), F.min("cluster").alias("cluster"), F.count("cluster").alias("n_matches"))


def subset_by_clusters(cells: DataFrame, mapping: DataFrame, label: str) -> DataFrame:
    """Cells with the subset that their label's Cnn code maps to; cells of unmapped clusters go. A code of several
    subsets, or of no cell, is an error."""
    repeated = mapping.groupBy("code").agg(F.countDistinct("subset").alias("_n")).where("_n > 1").limit(1).count()
    if repeated:
        raise ValueError("a cluster maps to several subsets")
    codes = cells.select(cluster_code(F.col(label)).alias("code")).distinct()
    if absent := [r["code"] for r in mapping.join(codes, "code", "left_anti").select("code").distinct().orderBy("code").limit(10).collect()]:
        raise ValueError(f"no cell is in the clusters {absent}")
    return cells.withColumn("code", cluster_code(F.col(label))).join(mapping, "code")


def subset_summary(marked: DataFrame) -> DataFrame:
    """Cells and clusters of each subset."""
    return marked.groupBy("subset").agg(F.count("*").alias("n_cells"), F.countDistinct("code").alias("n_clusters"))


def overlay(parent: DataFrame, children: list[DataFrame], label: str) -> DataFrame:
    """Parent labels with the children's over them; children must lie in the parent and be disjoint."""
    merged = reduce(DataFrame.unionByName, [c.select("cell_id", F.col(label).alias("_child")) for c in children])
    if merged.groupBy("cell_id").count().where("count > 1").limit(1).count():
        raise ValueError("children overlap")
    if merged.join(parent, "cell_id", "left_anti").limit(1).count():
        raise ValueError("a child has cells that the parent lacks")
    return parent.join(merged, "cell_id", "left").withColumn(label, F.coalesce("_child", label)).drop("_child")


def rename(cells: DataFrame, mapping: DataFrame, label: str) -> DataFrame:
    """Labels renamed by Cnn code; equal new labels collapse into one."""
    met = cells.withColumn("code", cluster_code(F.col(label))).join(mapping.toDF("code", "_new"), "code", "left")
    return met.withColumn(label, F.coalesce("_new", F.trim(F.regexp_replace(label, r"^C\d+:", "")))).drop("_new", "code")


def restrict_to_barcodes(raw: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Triples whose (sample, barcode) is listed."""
    return raw.join(barcodes, ["sample_id", "cell_id"], "left_semi")


def attach_layer(kept: DataFrame, raw: DataFrame, genes: DataFrame) -> DataFrame:
    """Raw triples of the kept cells and genes as a further layer; a kept cell without raw counts is an error."""
    if kept.join(raw.select("cell_id").distinct(), "cell_id", "left_anti").limit(1).count():
        raise ValueError("kept cells have no raw counts")
    return raw.join(kept.select("cell_id"), "cell_id", "left_semi").join(genes.select("gene_id"), "gene_id", "left_semi")


def contrast_table(pseudobulk: DataFrame, wilcoxon: DataFrame, logreg: DataFrame, by: list[str]) -> DataFrame:
    """Full outer assembly of per-gene results of three methods."""
    return pseudobulk.join(wilcoxon, by, "full_outer").join(logreg, by, "full_outer")


def first_by_prior(rows: DataFrame, key: list[str], prior: str, ascending: bool, limit: int | None = None) -> DataFrame:
    """The first row of each key by a prior (nulls last, key as tie-break), then the first ``limit`` of all."""
    column = F.col(prior).asc_nulls_last() if ascending else F.col(prior).desc_nulls_last()
    kept = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(column))).where("_r = 1").drop("_r")
    return kept if limit is None else kept.orderBy(column, *key).limit(limit)


def annotate_with_fallback(events: DataFrame, primary: DataFrame, fallback: DataFrame, id_key: str, name_key: str, value: str) -> DataFrame:
    """A value by id, else by normalised name; right sides are made unique by the least value first."""
    one = primary.groupBy(id_key).agg(F.min(value).alias("_a"))
    two = fallback.groupBy(F.lower(F.trim(name_key)).alias("_n")).agg(F.min(value).alias("_b"))
    met = events.join(one, id_key, "left").join(two, F.lower(F.trim(events[name_key])) == F.col("_n"), "left")
    return met.withColumn(value, F.coalesce("_a", "_b")).drop("_a", "_b", "_n")


def levels_present(rows: DataFrame, context: list[str], level: str, pair: tuple[str, str], least: int = 1) -> DataFrame:
    """Contexts in which both levels of a contrast have enough rows."""
    n = [F.sum((F.col(level) == x).cast("long")) for x in pair]
    return rows.groupBy(*context).agg(n[0].alias("n_a"), n[1].alias("n_b")).where((F.col("n_a") >= least) & (F.col("n_b") >= least))
