"""Readers and writers: sparse-matrix folders, gene sets, mapping tables, result folders, datasets."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..model import Dataset

COUNTS = "cell_id string, gene_id string, layer string, value double"


def _place() -> Column:
    """Where a line stands in its file: the split's start, then its place in the split, which one task reads in order."""
    return F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))


def _numbered(lines: DataFrame, name: str) -> DataFrame:
    """Lines of small text files with their number from 1, per sample, in file order (``_at``)."""
    order = Window.partitionBy("sample_id").orderBy("_at")
    return lines.withColumn(name, F.row_number().over(order)).drop("_at")


def sample_of(path: Column, suffix: str = "") -> Column:
    """The sample of a file: its folder's name, cut before a suffix."""
    folder = F.element_at(F.split(path, "/"), -2)
    return F.regexp_replace(folder, f"{suffix}$", "") if suffix else folder


def read_matrix_folders(spark: SparkSession, pattern: str, suffix: str = "", layer: str = "X") -> tuple[DataFrame, DataFrame]:
    """(obs, counts) of matrix folders: ``matrix.mtx`` with ``barcodes.tsv`` and ``features.tsv`` (or ``genes.tsv``), plain or gzipped.

    One read over all folders; the sample is the folder's name, the cell id ``sample_barcode``. The triples'
    indices are resolved by joins with the numbered barcode and feature lists, which are dimensions.
    """
    text = lambda glob: spark.read.text(f"{pattern}/{glob}").withColumn("_at", _place()).withColumn("sample_id", sample_of(F.col("_metadata.file_path"), suffix))
    barcodes = _numbered(text("barcodes.tsv*"), "j").select("sample_id", "j", F.trim("value").alias("barcode"))
    features = _numbered(text("{features,genes}.tsv*"), "i").select("sample_id", "i", F.split("value", "\t").alias("f")).select("sample_id", "i", F.coalesce(F.get("f", F.lit(1)), F.get("f", F.lit(0))).alias("gene_id"))
    sized = text("matrix.mtx*").where(~F.col("value").startswith("%") & (F.trim("value") != "")).select("sample_id", "_at", F.split(F.trim("value"), r"\s+").alias("p"))
    # the size line is the first line of the file's body
    first = sized.groupBy("sample_id").agg(F.min("_at").alias("_first"))
    entries = sized.join(F.broadcast(first), "sample_id").where("_at > _first").select("sample_id", F.col("p")[0].cast("int").alias("i"), F.col("p")[1].cast("int").alias("j"), F.col("p")[2].cast("double").alias("value")).where("value != 0")
    cell = F.concat_ws("_", "sample_id", "barcode")
    counts = entries.join(F.broadcast(features), ["sample_id", "i"]).join(barcodes, ["sample_id", "j"]).select(cell.alias("cell_id"), "gene_id", F.lit(layer).alias("layer"), "value")
    return barcodes.select(cell.alias("cell_id"), "sample_id", "barcode"), counts.groupBy("cell_id", "gene_id", "layer").agg(F.sum("value").alias("value"))


def sample_folders(spark: SparkSession, pattern: str, suffix: str = "") -> dict[str, str]:
    """Folders that match a pattern, by sample: the folder's name before a suffix. Names that clash are an error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    out: dict[str, str] = {}
    for status in found:
        if status.isDirectory():
            name = status.getPath().getName()
            name = name[: -len(suffix)] if suffix and name.endswith(suffix) else name
            if name in out:
                raise ValueError(f"two folders are of the sample {name!r}")
            out[name] = status.getPath().toString()
    return out


def load_samples(spark: SparkSession, pattern: str, suffix: str = "", *, layer: str = "counts_raw", call: bool = False, barcodes: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(obs, counts, totals) of all matching folders in one read. ``call`` keeps the barcodes that cell calling passes;
    ``barcodes`` (sample_id, barcode) those listed, where a sample without any is an error. ``totals`` has a sample's
    counts before and after, and its kept barcodes."""
    if not sample_folders(spark, pattern, suffix):
        raise FileNotFoundError(pattern)
    obs, counts = read_matrix_folders(spark, pattern, suffix, layer)
    sums = counts.groupBy("cell_id").agg(F.sum("value").alias("total"))
    met = obs.join(sums, "cell_id", "left").withColumn("total", F.coalesce("total", F.lit(0.0)))
    kept = met
    if call:
        from ..operators.kernels import call_cells

        cut = call_cells(met.select("sample_id", "total"))
        kept = kept.join(F.broadcast(cut.select("sample_id", "cutoff")), "sample_id").where("total >= coalesce(cutoff, 0)").drop("cutoff")
    if barcodes is not None:
        lacking = [r["sample_id"] for r in obs.select("sample_id").distinct().join(barcodes.select("sample_id").distinct(), "sample_id", "left_anti").orderBy("sample_id").limit(10).collect()]
        if lacking:
            raise ValueError(f"samples without a list of barcodes: {lacking}")
        kept = kept.join(barcodes.select("sample_id", "barcode").distinct(), ["sample_id", "barcode"], "left_semi")
    before = met.groupBy("sample_id").agg(F.sum("total").alias("counts_before"))
    after = kept.groupBy("sample_id").agg(F.sum("total").alias("counts_after"), F.count("*").alias("n_cells"))
    totals = before.join(after, "sample_id", "left").na.fill({"counts_after": 0.0, "n_cells": 0})
    return kept.drop("total"), counts.join(kept.select("cell_id"), "cell_id", "left_semi"), totals


def read_barcodes(spark: SparkSession, pattern: str, suffix: str) -> DataFrame:
    """(sample_id, barcode) of lists named by their sample and a suffix."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    rows = spark.read.text(pattern).select(F.regexp_replace(name, f"{suffix}$", "").alias("sample_id"), F.trim(F.substring_index("value", ",", 1)).alias("barcode"))
    return rows.where("barcode != ''")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A csv or tsv with a header; every column a string, as keys may look like numbers."""
    return spark.read.csv(path, header=True, sep="\t" if path.split(".")[-1] in ("tsv", "txt") else ",")


def read_gmt(spark: SparkSession, path: str) -> DataFrame:
    """Gene sets (source, target, weight 1, ord): lines of at least three tab-separated fields; genes of a term that
    comes up again are added, in order, each once."""
    lines = spark.read.text(path).select(F.split("value", "\t").alias("p"), F.struct(F.col("_metadata.file_path").alias("file"), _place().alias("at")).alias("_line")).where(F.size("p") >= 3)
    genes = lines.select(F.trim(F.col("p")[0]).alias("source"), "_line", F.posexplode(F.expr("slice(p, 3, size(p) - 2)")).alias("_pos", "target")).withColumn("target", F.trim("target")).where("target != ''")
    first = genes.groupBy("source", "target").agg(F.min(F.struct("_line", "_pos")).alias("_at"))
    return first.select("source", "target", F.lit(1.0).alias("weight"), F.row_number().over(Window.partitionBy("source").orderBy("_at")).alias("ord"))


def read_modules(spark: SparkSession, path: str) -> DataFrame:
    """Gene modules (source, target): a gmt, a table with module and gene columns, or a plain list named by its file."""
    kind, stem = path.rsplit(".", 1)[-1].lower(), path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    if kind == "gmt":
        return read_gmt(spark, path).select("source", "target")
    if kind in ("tsv", "csv"):
        table = read_table(spark, path)
        low = {c.lower(): c for c in table.columns}
        module = next((low[c] for c in ("module", "set", "signature") if c in low), None)
        gene = next((low[c] for c in ("gene", "genes", "symbol") if c in low), None)
        if module is None and gene is None and len(table.columns) >= 2:
            module, gene = table.columns[:2]
        name = F.trim(F.col(f"`{module}`")) if module else F.lit(stem)
        return table.select(name.alias("source"), F.trim(F.col(f"`{gene or table.columns[0]}`")).alias("target")).where("target != ''").distinct()
    return spark.read.text(path).select(F.lit(stem).alias("source"), F.trim("value").alias("target")).where("target != '' and not startswith(target, '#')").distinct()


def read_mapping(spark: SparkSession, path: str, names: tuple[str, str], strict_code: bool = False) -> DataFrame:
    """A two-column tab-separated mapping; ``#`` comments; codes must be C and digits where asked."""
    rows = spark.read.text(path).where("trim(value) != '' and not startswith(trim(value), '#')").select(F.split("value", "\t").alias("p"))
    if rows.where("size(p) < 2").limit(1).count():
        raise ValueError(f"{path}: a line has no tab")
    out = rows.select(F.trim(F.col("p")[0]).alias(names[0]), F.trim(F.col("p")[1]).alias(names[1]))
    if strict_code and out.where(~F.col(names[0]).rlike(r"^C\d+$")).limit(1).count():
        raise ValueError(f"{path}: codes are C and digits")
    return out


def read_result_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Result tables of a folder as one, condition, contrast and cluster parsed from ``condition__contrast__cluster.csv``."""
    rows = spark.read.csv(f"{folder}/*.csv", header=True).withColumn("_file", F.element_at(F.split("_metadata.file_path", "/"), -1))
    part = lambda k: F.regexp_extract("_file", r"^(.*?)__(.*?)__(.*)\.csv$", k)
    return rows.withColumn("condition_key", part(1)).withColumn("contrast", part(2)).withColumn("cluster", part(3)).drop("_file")


#: Tables of one contrast by how they are preferred.
KINDS = ("combined", "wilcoxon", "logreg", "pseudobulk_effect")


def read_pseudobulk_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Result tables ``condition_within_cluster__<condition>/condition_within_cluster__<cluster>__<contrast>.csv`` as one,
    with condition_key, contrast and cluster; summaries are left out."""
    rows = spark.read.csv(f"{folder}/condition_within_cluster__*/condition_within_cluster__*.csv", header=True).withColumn("_p", F.split("_metadata.file_path", "/"))
    stem = F.regexp_extract(F.element_at("_p", -1), r"^condition_within_cluster__(.*)\.csv$", 1)
    named = rows.withColumn("condition_key", F.regexp_replace(F.element_at("_p", -2), "^condition_within_cluster__", "")).withColumn("_s", stem)
    contrast = F.regexp_extract("_s", "^.*?__(.*)$", 1)
    return named.withColumn("cluster", F.substring_index("_s", "__", 1)).withColumn("contrast", F.when(contrast != "", contrast).otherwise(F.lit("contrast"))).drop("_p", "_s")


def read_cell_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Result tables ``<condition>_<pair>_DE/.../cluster__<cluster>__<pair>__<kind>.csv`` as one, with condition_key,
    contrast, cluster and kind; of the kinds of a contrast and cluster only the most preferred that has rows."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "cluster__*__*__*.csv").csv(folder, header=True)
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    part = lambda k: F.regexp_extract(name, r"^cluster__(.*?)__(.*)__([^_]+(?:_[^_]+)*)\.csv$", k)
    of = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]*)_DE/", 1)
    rows = rows.withColumn("cluster", part(1)).withColumn("contrast", part(2)).withColumn("kind", part(3)).withColumn("_c", of).where(F.col("kind").isin(*KINDS))
    rows = rows.withColumn("condition_key", F.when(F.expr("endswith(_c, concat('_', contrast))"), F.expr("left(_c, length(_c) - length(contrast) - 1)")).otherwise(F.col("_c"))).drop("_c")
    key = ["condition_key", "contrast", "cluster"]
    rank = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    best = rows.withColumn("_k", rank).groupBy(*key).agg(F.min("_k").alias("_best"))
    return rows.withColumn("_k", rank).join(F.broadcast(best), key).where("_k = _best").drop("_k", "_best")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Candidate events: a csv or tsv whose ligand, receptor, source and target go by any of their names."""
    rows = read_table(spark, path)
    names = {"source": ("source", "sender", "source_token"), "target": ("target", "receiver", "target_token"), "ligand": ("ligand", "ligand_complex"), "receptor": ("receptor", "receptor_complex")}
    have = {c.lower(): c for c in rows.columns}
    picked = {want: next((have[n] for n in known if n in have), None) for want, known in names.items()}
    if lacking := [k for k, v in picked.items() if v is None]:
        raise ValueError(f"{path}: no column for {lacking}")
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in picked.values()]
    return rows.select(*(F.col(f"`{v}`").alias(k) for k, v in picked.items()), *rest)


def read_gene_annotation(spark: SparkSession, path: str) -> DataFrame:
    """(gene_id, gene_type, chromosome, ensembl_gene_id) of a local annotation table with any of these names' spellings;
    the least of several rows of a gene. What a table lacks is null."""
    rows = read_table(spark, path)
    low = {c.lower(): c for c in rows.columns}
    names = {"gene_id": ("gene", "symbol", "gene_name", "external_gene_name", "hgnc_symbol", "gene_id"), "gene_type": ("gene_type", "gene_biotype", "biotype"), "chromosome": ("chromosome", "chrom", "chromosome_name", "gene_chrom"), "ensembl_gene_id": ("ensembl_gene_id", "ensembl")}
    pick = {k: next((low[n] for n in known if n in low), None) for k, known in names.items()}
    if pick["gene_id"] is None:
        raise ValueError(f"{path}: no column of genes")
    one = rows.select(*(F.trim(F.col(f"`{c}`")).alias(k) if c else F.lit(None).cast("string").alias(k) for k, c in pick.items()))
    return one.where("gene_id != ''").groupBy("gene_id").agg(*(F.min(c).alias(c) for c in ("gene_type", "chromosome", "ensembl_gene_id")))


def gene_type_from_name(gene: Column) -> Column:
    """Gene type from a name's prefix, where no annotation is at hand."""
    up = F.upper(gene)
    rules = (("MT-", "Mt"), ("LINC", "lincRNA"), ("LOC", "LOC"), ("MIR", "miRNA"), ("RNP", "RNP"), ("RNU", "snRNA"), ("SNORD", "snoRNA"), ("SNORA", "snoRNA"), ("SCARNA", "scaRNA"))
    out = F.lit("protein_coding")
    for prefix, kind in reversed(rules):
        out = F.when(up.startswith(prefix), F.lit(kind)).otherwise(out)
    return out


def save_dataset(data: Dataset, path: str) -> None:
    """One folder of parquet tables; counts are partitioned by layer. Table names that clash but for case or marks get
    folders with a hash of their name."""
    seen: dict[str, str] = {}
    for name in sorted(data.tables):
        safe = "".join(c if c.isalnum() else "_" for c in name).lower()
        seen[safe if safe not in seen else f"{safe}_{hashlib.md5(name.encode()).hexdigest()[:8]}"] = name
    data.obs.write.mode("overwrite").parquet(f"{path}/obs")
    data.var.write.mode("overwrite").parquet(f"{path}/var")
    data.counts.write.mode("overwrite").partitionBy("layer").parquet(f"{path}/counts")
    spark = data.obs.sparkSession
    for safe, name in seen.items():
        data.tables[name].write.mode("overwrite").parquet(f"{path}/tables/{safe}")
    index = [(safe, name) for safe, name in seen.items()]
    spark.createDataFrame(index or [("", "")], "folder string, name string").coalesce(1).write.mode("overwrite").json(f"{path}/index")


def load_dataset(spark: SparkSession, path: str) -> Dataset:
    read = lambda t: spark.read.parquet(f"{path}/{t}")
    index = {r["name"]: r["folder"] for r in spark.read.schema("folder string, name string").json(f"{path}/index").collect() if r["folder"]}
    return Dataset(read("obs"), read("var"), read("counts").select("cell_id", "gene_id", F.col("layer").cast("string"), "value"), {name: read(f"tables/{folder}") for name, folder in index.items()})


def export_annotations(data: Dataset, path: str, columns: list[str], round_id: str | None = None) -> None:
    """Selected columns of the cells as csv, with the labels of a round where the dataset has rounds: of the one named,
    else of the active one. Columns that the cells lack are skipped."""
    rows = data.obs.select("cell_id", *(c for c in columns if c in data.obs.columns and c != "cell_id"))
    if "rounds" in data.tables and "round_labels" in data.tables:
        held = data.tables["rounds"]
        chosen = held.where(F.col("round_id") == round_id) if round_id else held.where("active")
        labels = data.tables["round_labels"].join(F.broadcast(chosen.select("round_id")), "round_id", "left_semi")
        rows = rows.join(labels.select(F.col("cell_id"), F.col("cluster_id").alias("round_cluster")), "cell_id", "left")
    rows.write.mode("overwrite").option("header", True).csv(path)


def export_results(table: DataFrame, path: str) -> None:
    """Result tables as csv files by condition_key, contrast and cluster, what of these a table has."""
    export_tables(table, path, [c for c in ("condition_key", "contrast", "cluster") if c in table.columns])


def export_payloads(payloads: dict[str, dict[str, DataFrame]], path: str) -> None:
    """Enrichment tables (net by net: activity, results, activity_<collection>) as folders ``<net>/<table>``."""
    for net, tables in payloads.items():
        safe = "".join(c if c.isalnum() or c in "._-" else "_" for c in net)
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{safe}/{name}")


def load_payloads(spark: SparkSession, path: str) -> dict[str, dict[str, DataFrame]]:
    """What ``export_payloads`` wrote, and under ``activity_by_collection`` its parts as one table."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    listed = lambda p: sorted(s.getPath().getName() for s in hadoop(p).getFileSystem(conf).listStatus(hadoop(p)) if s.isDirectory())
    out = {}
    for net in listed(path):
        tables = {name: spark.read.parquet(f"{path}/{net}/{name}") for name in listed(f"{path}/{net}")}
        parts = [t.withColumn("collection", F.lit(n.removeprefix("activity_"))) for n, t in tables.items() if n.startswith("activity_")]
        if parts:
            whole = parts[0]
            for p in parts[1:]:
                whole = whole.unionByName(p, allowMissingColumns=True)
            tables["activity_by_collection"] = whole
        out[net] = tables
    return out


def export_tables(table: DataFrame, path: str, by: list[str]) -> None:
    """CSV files by partition columns."""
    table.write.mode("overwrite").partitionBy(*by).option("header", True).csv(path)


def provenance(spark: SparkSession, key: str, values: dict) -> DataFrame:
    return spark.createDataFrame([(key, json.dumps(values, sort_keys=True))], "key string, value string")
