"""Commands: ``list`` and ``run`` for the registered queries, and one for each run on a stored dataset.

    python -m gridloom de --data DIR --cluster leiden --condition sex --contrast F_vs_M --out DIR
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import api, runs
from .operators import conditions, genes, merge, rounds
from .plans.queries import ORACLES, QUERIES
from .session import build_session
from .sources import archives, collections, files


def _options(parser: argparse.ArgumentParser, *names: str) -> None:
    """Options that commands share; those without a default are required."""
    known = {
        "data": {}, "out": {}, "cluster": {}, "sample": {"default": "sample_id"}, "condition": {}, "group": {}, "label": {}, "folder": {}, "pairs": {}, "events": {}, "mapping": {}, "metadata": {},
        "contrast": {"action": "append"}, "reference": {"default": None}, "covariate": {"action": "append"}, "filter": {"action": "append"}, "sets": {"action": "append"}, "method": {"action": "append"},
    }
    for name in names:
        parser.add_argument(f"--{name}", required=name in known and not known[name], **known.get(name, {}))


def _write(tables: dict[str, DataFrame], out: str) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{out}/{name}")


def _sets(given: argparse.Namespace) -> list[str]:
    asked = given.sets or list(collections.DEFAULT)
    return asked if all(x.endswith(".gmt") for x in asked) else collections.resolve(asked, given.collections or ".")[0]


def _pair(text: str) -> tuple[str, str]:
    return conditions.parse_contrast(text)


def _load_and_filter(spark: SparkSession, g: argparse.Namespace) -> None:
    obs, counts, totals = files.load_samples(spark, g.folder, g.suffix, call=g.call_cells)
    data = api.Dataset(obs, counts.select("gene_id").distinct(), counts)
    subsets = {"mt": F.upper("gene_id").startswith("MT-"), "ribo": F.upper("gene_id").rlike("^RP[SL]")}
    found = runs.filter_and_prepare(data, subsets, sample=g.sample, n_genes=g.n_genes, min_genes=g.min_genes)
    kept = found["dataset"]
    kept.tables.update(totals=totals, filtered_cells=found["cells"], variable_genes=found["variable"])
    files.save_dataset(kept, g.out)


def _subset(spark: SparkSession, g: argparse.Namespace) -> None:
    data = files.load_dataset(spark, g.data)
    mapping = files.read_mapping(spark, g.mapping, ("code", "subset"), True)
    for name, part in api.subset_by_cluster_mapping(data, mapping, g.label).items():
        files.save_dataset(part, f"{g.out}/{name}")


def _rename(spark: SparkSession, g: argparse.Namespace) -> None:
    mapping = files.read_mapping(spark, g.mapping, ("code", "name"), True)
    files.save_dataset(api.rename_idents(files.load_dataset(spark, g.data), mapping, g.label), g.out)


def _annotation_merge(spark: SparkSession, g: argparse.Namespace) -> None:
    data = files.load_dataset(spark, g.data)
    children = [files.load_dataset(spark, c).obs for c in g.child]
    data.obs = merge.overlay(data.obs, children, g.label)
    data.tables["round_display"] = rounds.display(data.obs.select("cell_id", F.col(g.label).alias("cluster_id")))
    files.save_dataset(data, g.out)


def _merge(spark: SparkSession, g: argparse.Namespace) -> None:
    parts = {p.rstrip("/").rsplit("/", 1)[-1]: files.load_dataset(spark, p) for p in g.part}
    display = None
    if g.tokens:
        parts, display = runs.merge_tokens(parts, files.read_mapping(spark, g.tokens, ("dataset", "token")), g.label)
    merged = api.merge_datasets(parts, g.how)
    if display is not None:
        merged.tables["display"] = display
    files.save_dataset(merged, g.out)


def _metadata(spark: SparkSession, g: argparse.Namespace) -> None:
    rows = files.read_table(spark, g.metadata)
    files.save_dataset(api.add_obs_metadata(files.load_dataset(spark, g.data), rows, g.key or rows.columns[0], g.sample, exact=not g.loose), g.out)


def _de(spark: SparkSession, g: argparse.Namespace) -> None:
    second = _pair(g.second) if g.second else None
    found = runs.differential(files.load_dataset(spark, g.data), g.cluster, g.condition, sample=g.sample, contrasts=g.contrast, reference=g.reference, covariates=tuple(g.covariate or ()), gene_filter=g.filter, least=g.least, second=second)
    _write(found, g.out)


def _markers(spark: SparkSession, g: argparse.Namespace) -> None:
    _write(runs.markers(files.load_dataset(spark, g.data), g.cluster, sample=g.sample, covariates=tuple(g.covariate or ())), g.out)


def _da(spark: SparkSession, g: argparse.Namespace) -> None:
    _write(runs.abundance(files.load_dataset(spark, g.data), g.cluster, g.sample, g.condition, g.reference), g.out)


def _ligand_receptor(spark: SparkSession, g: argparse.Namespace) -> None:
    _write(runs.signalling(files.load_dataset(spark, g.data), g.group, files.read_table(spark, g.pairs).select("ligand", "receptor"), condition=g.condition, n_perms=g.permutations), g.out)


def _ligand_receptor_paired(spark: SparkSession, g: argparse.Namespace) -> None:
    data = files.load_dataset(spark, g.data)
    display = data.obs.select(F.col(g.group).cast("string").alias("label")).distinct().withColumn("cluster", F.col("label"))
    _write(runs.paired_signalling(data, g.group, g.sample, g.condition, _pair(g.contrast[0]), files.read_events(spark, g.events), display, limit=g.limit), g.out)


def _metabolite_paired(spark: SparkSession, g: argparse.Namespace) -> None:
    events = files.read_table(spark, g.events).withColumn("event", F.expr("try_cast(event as bigint)"))
    estimates = spark.read.parquet(g.estimates) if g.estimates else None
    _write(runs.paired_metabolites(files.load_dataset(spark, g.data), g.group, g.sample, g.condition, _pair(g.contrast[0]), events, method=runs.signals.SENSOR if estimates is not None else runs.signals.PROXY, estimates=estimates), g.out)


def _ligand_targets(spark: SparkSession, g: argparse.Namespace) -> None:
    targets = spark.read.parquet(g.targets)
    _write(runs.ligand_targets(files.load_dataset(spark, g.data), g.group, g.sender, g.receiver, files.read_table(spark, g.pairs).select("ligand", "receptor"), targets, level=g.condition, pair=_pair(g.contrast[0])), g.out)


def _enrich_cluster(spark: SparkSession, g: argparse.Namespace) -> None:
    _write(runs.enrich_clusters(files.load_dataset(spark, g.data), g.group, _sets(g), condition=g.condition, methods=tuple(g.method or ("ulm",)), gene_filter=g.filter), g.out)


def _enrich_de(spark: SparkSession, g: argparse.Namespace) -> None:
    _write(runs.enrich_result_folder(spark, g.folder, _sets(g), g.source, permutations=g.permutations), g.out)


def _module_score(spark: SparkSession, g: argparse.Namespace) -> None:
    scored, summary = api.module_score(files.load_dataset(spark, g.data), g.modules, g.group)
    _write({"scores": scored, "summary": summary}, g.out)


def _genes(spark: SparkSession, g: argparse.Namespace) -> None:
    data = files.load_dataset(spark, g.data)
    annotation = files.read_gene_annotation(spark, g.annotation) if g.annotation else None
    genes.filter_genes(data.var, g.filter or [], annotation).write.mode("overwrite").parquet(g.out)


def _archive(spark: SparkSession | None, g: argparse.Namespace) -> None:
    print(archives.unpack(g.data, g.out) if g.data.endswith(archives.SUFFIX) else archives.pack(g.data, g.out))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gridloom", description=__doc__.split("\n")[0])
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, run, *shared: str, **own) -> None:
        one = commands.add_parser(name)
        one.set_defaults(run=run)
        one.add_argument("--master", default=None, help="a master URL; without one, that of spark-submit or local[*]")
        _options(one, *shared)
        for option, how in own.items():
            one.add_argument(f"--{option.replace('_', '-')}", **how)

    text, many = {"default": None}, {"action": "append", "required": True}
    number = lambda n: {"type": int, "default": n}
    add("load-and-filter", _load_and_filter, "folder", "out", "sample", suffix={"default": ""}, call_cells={"action": "store_true"}, n_genes=number(2000), min_genes=number(200))
    add("subset", _subset, "data", "mapping", "label", "out")
    add("rename", _rename, "data", "mapping", "label", "out")
    add("annotation-merge", _annotation_merge, "data", "label", "out", child=many)
    add("merge", _merge, "out", part=many, tokens=text, label={"default": "cluster_label"}, how={"default": "outer", "choices": ["outer", "inner"]})
    add("metadata-import", _metadata, "data", "metadata", "out", "sample", key=text, loose={"action": "store_true"})
    add("markers", _markers, "data", "cluster", "out", "sample", "covariate")
    add("de", _de, "data", "cluster", "condition", "out", "sample", "contrast", "reference", "covariate", "filter", second=text, least=number(50))
    add("da", _da, "data", "cluster", "condition", "out", "sample", "reference")
    add("ligand-receptor", _ligand_receptor, "data", "group", "pairs", "out", condition=text, permutations=number(1000))
    add("ligand-receptor-paired", _ligand_receptor_paired, "data", "group", "condition", "events", "out", "sample", "contrast", limit=number(200))
    add("metabolite-paired", _metabolite_paired, "data", "group", "condition", "events", "out", "sample", "contrast", estimates=text)
    add("ligand-targets", _ligand_targets, "data", "group", "condition", "pairs", "out", "contrast", sender={"required": True}, receiver={"required": True}, targets={"required": True})
    add("enrichment-cluster", _enrich_cluster, "data", "group", "out", "sets", "method", "filter", condition=text, collections=text)
    add("enrichment-de", _enrich_de, "folder", "out", "sets", source={"default": "auto"}, permutations=number(1000), collections=text)
    add("module-score", _module_score, "data", "group", "out", modules={"required": True})
    add("genes", _genes, "data", "out", "filter", annotation=text)
    add("archive", _archive, "data", "out")
    commands.add_parser("list", help="names of the queries; a star marks those with a DuckDB text")
    query = commands.add_parser("run", help="runs a query over a folder of parquet tables")
    query.add_argument("name", choices=sorted(QUERIES))
    query.add_argument("folder")
    query.add_argument("--out", help="writes parquet there instead of showing 20 rows")
    query.add_argument("--master", default=None)
    return parser


def main(arguments: list[str] | None = None) -> int:
    given = _parser().parse_args(arguments)
    if given.command == "list":
        for name in sorted(QUERIES):
            print(name + " *" * (name in ORACLES))
        return 0
    if given.command == "archive":
        _archive(None, given)
        return 0
    spark = SparkSession.getActiveSession() or build_session(given.master or "local[*]")
    if given.command != "run":
        given.run(spark, given)
        return 0
    rows = QUERIES[given.name](spark, given.folder)
    if given.out:
        rows.write.mode("overwrite").parquet(given.out)
    else:
        rows.show(20, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
