"""Whole runs on datasets: each composes operators to the tables of one analysis, as a dictionary of lazy frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.columns import benjamini_hochberg, top_k
from .model import Dataset
from .operators import communication, composition, conditions, enrichment, genes, kernels, merge, nbtests, pseudobulk, qc, ranking, ranktests, selection, signals, tasks
from .sources import files
from .sources.lineage import materialise


def _context(obs: DataFrame, cluster: str, condition: conditions.Condition) -> DataFrame:
    """Cells with _cluster and _level; of ``A@B`` every level of B is its own set of clusters."""
    name = F.col(cluster).cast("string")
    if condition.within:
        name = F.concat(name, F.lit(" @ "), F.col(condition.within).cast("string"))
    return obs.withColumn("_cluster", name).withColumn("_level", condition.column()).where("_cluster is not null and _level is not null")


def _pairs(obs: DataFrame, contrasts: list[str] | None, reference: str | None) -> DataFrame:
    if contrasts:
        return obs.sparkSession.createDataFrame([conditions.parse_contrast(c) for c in contrasts], "a string, b string")
    return conditions.versus_reference(obs, "_level", reference) if reference else conditions.all_pairs(obs, "_level")


def _fold_changes(layer: DataFrame, obs: DataFrame, pairs: DataFrame, pseudocount: float = 1e-9) -> DataFrame:
    """log2 of the ratio of mean expm1 of the levels, by cluster, pair and gene; genes without a value are 0."""
    sizes = obs.groupBy("_cluster", "_level").agg(F.count("*").alias("_n"))
    sums = layer.join(obs.select("cell_id", "_cluster", "_level"), "cell_id").groupBy("_cluster", "_level", "gene_id").agg(F.sum(F.expm1("value")).alias("_s"))
    mean = sums.join(sizes, ["_cluster", "_level"]).select("_cluster", "_level", "gene_id", (F.col("_s") / F.col("_n")).alias("_m"))
    both = mean.join(F.broadcast(pairs), (F.col("_level") == F.col("a")) | (F.col("_level") == F.col("b")))  # pairs are a few
    of = lambda x: F.coalesce(F.max(F.when(F.col("_level") == F.col(x), F.col("_m"))), F.lit(0.0)) + pseudocount
    return both.groupBy("_cluster", "a", "b", "gene_id").agg(F.log2(of("a") / of("b")).alias("lfc"))


def differential(data: Dataset, cluster: str, condition: str, *, sample: str = "sample_id", contrasts: list[str] | None = None, reference: str | None = None, covariates: tuple[str, ...] = (), gene_filter: list[str] | None = None, least: int = 50, min_pct: float = 0.1, min_diff: float = 0.0, second: tuple[str, str] | None = None, pseudobulk_tests: bool = True) -> dict[str, DataFrame]:
    """Levels of a condition against each other within every cluster.

    ``condition`` is ``A``, ``A:B``, ``A@B`` or ``A^B``; contrasts are named, against a reference, or all pairs. Tables:
    ``tasks`` (cells of both sides and why one is skipped), ``cell`` (rank tests with fold changes, shares and padj of the
    tasks that run), ``pseudobulk`` (negative binomial tests) and ``combined`` (tiers). ``A^B`` gives ``interaction`` only,
    of the contrast of A between the two levels ``second`` of B.
    """
    parsed = conditions.parse(condition)
    raw = data.layer()
    if gene_filter:
        kept = genes.filter_genes(data.var, gene_filter).select("gene_id")
        raw = raw.join(kept, "gene_id", "left_semi")
    if parsed.interaction:
        if not contrasts or second is None:
            raise ValueError("an interaction needs one contrast of either factor")
        a, b = conditions.parse_contrast(contrasts[0])
        return {"interaction": nbtests.interaction(raw, data.obs, sample, cluster, (parsed.factors[0], a, b), (parsed.interaction, *second), covariates=covariates)}
    obs = materialise(_context(data.obs, cluster, parsed))
    pairs = materialise(_pairs(obs, contrasts, reference))
    planned = tasks.contrast_tasks(obs, "_cluster", "_level", pairs, least)
    layer = qc.lognorm(raw)
    found = [ranktests.wilcoxon_levels(layer, obs, "_cluster", "_level", r["a"], r["b"]).withColumn("a", F.lit(r["a"])).withColumn("b", F.lit(r["b"])) for r in pairs.orderBy("a", "b").collect()]  # one row a contrast
    out = {"tasks": planned.withColumnRenamed("_cluster", "cluster")}
    if not found:
        return out
    tests = reduce(DataFrame.unionByName, found)
    runs = F.broadcast(planned.where("skip_reason is null").select("_cluster", "a", "b"))
    tests = tests.join(runs, ["_cluster", "a", "b"], "left_semi").join(_fold_changes(layer, obs, pairs), ["_cluster", "a", "b", "gene_id"], "left")
    adjusted = benjamini_hochberg(tests, "pval", ("_cluster", "a", "b"), tie=("gene_id",))
    ok = (F.greatest("pct_a", "pct_b") >= min_pct) & (F.abs(F.col("pct_a") - F.col("pct_b")) >= min_diff)
    cell = adjusted.withColumn("ok", ok).withColumnRenamed("_cluster", "cluster")
    out["cell"] = cell
    wide = cell.select("cluster", "a", "b", "gene_id", F.col("lfc").alias("wilcoxon_lfc"), F.col("padj").alias("wilcoxon_padj"), "ok")
    if pseudobulk_tests:
        levels = obs.drop("condition") if "condition" in obs.columns and "condition" not in covariates else obs
        fits = nbtests.condition_within_cluster(raw, levels, sample, "_cluster", "_level", pairs, covariates=covariates)
        out["pseudobulk"] = fits
        wide = wide.join(fits.select("cluster", "a", "b", "gene_id", F.col("log2fc").alias("pb_lfc")), ["cluster", "a", "b", "gene_id"], "left")
    else:
        wide = wide.withColumn("pb_lfc", F.lit(None).cast("double"))
    out["combined"] = ranktests.consensus_tiers(wide.withColumn("logreg_coef", F.lit(None).cast("double")), with_pseudobulk=pseudobulk_tests)
    return out


def markers(data: Dataset, cluster: str, *, sample: str | None = "sample_id", most_cells: int = 0, n_genes: int = 100, min_pct: float = 0.1, min_diff: float = 0.05, covariates: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Every cluster against the rest: ``cell`` (rank tests; genes of the shares asked for and of positive fold change, the
    first by padj) and, with a sample column, ``pseudobulk``. ``most_cells`` bounds a cluster's cells in the rank tests."""
    obs = data.obs.where(F.col(cluster).isNotNull())
    drawn = ranking.stratified(obs, cluster, most_cells) if most_cells else obs
    layer = qc.lognorm(data.layer()).join(drawn.select("cell_id"), "cell_id", "left_semi")
    tests = benjamini_hochberg(ranktests.wilcoxon(layer, drawn, cluster), "pval", (cluster,), tie=("gene_id",))
    ok = (F.greatest("pts", "pts_rest") >= min_pct) & (F.abs(F.col("pts") - F.col("pts_rest")) >= min_diff) & (F.col("lfc") > 0)
    out = {"cell": top_k(tests.where(ok), n_genes, [cluster], F.col("padj"), F.desc("lfc"), F.col("gene_id"), rank="rank")}
    if sample:
        out["pseudobulk"] = nbtests.cluster_versus_rest(data.layer(), obs, sample, cluster, covariates=covariates, positive_only=True)
    return out


def abundance(data: Dataset, cluster: str, sample: str, condition: str, reference: str, *, neighbourhoods: DataFrame | None = None, radius: DataFrame | None = None, least_samples: int = 2) -> dict[str, DataFrame]:
    """Which clusters are more frequent where: ``table``, ``glm`` (binomial), ``clr`` (rank tests), ``graph`` where tables
    of neighbourhoods are given, and ``consensus`` over them."""
    obs = data.obs.where(F.col(cluster).isNotNull() & F.col(condition).isNotNull())
    pseudobulk.require_samples(obs, sample, condition, least_samples)
    levels = obs.groupBy(sample).agg(F.min(F.col(condition).cast("string")).alias("_level"))
    table = materialise(pseudobulk.crosstab(obs, sample, cluster).drop("share").join(levels, sample))
    totals = table.groupBy(sample).agg(F.sum("n").alias("total"))
    rows = table.join(totals, sample).select(F.col(cluster).cast("string").alias("cluster"), F.col("_level").alias("condition"), "n", "total")
    glm = benjamini_hochberg(kernels.composition_glm(rows, reference), "pval", (), out="fdr", tie=("cluster", "term"))
    ratios = composition.clr_mann_whitney(table, sample, cluster, "_level")
    at = (F.col("level_ref") == reference) | (F.col("level_test") == reference)
    sign = F.when(F.col("level_ref") == reference, 1.0).otherwise(-1.0)
    one = [glm.select("cluster", "term", F.lit("glm").alias("method"), "effect", "fdr"), ratios.where(at).select(F.col("cluster").cast("string").alias("cluster"), F.when(F.col("level_ref") == reference, F.col("level_test")).otherwise(F.col("level_ref")).alias("term"), F.lit("clr").alias("method"), (F.col("log2fc") * sign).alias("effect"), "fdr")]
    out = {"table": table.withColumnRenamed("_level", condition if condition != sample else "level"), "glm": glm, "clr": ratios}
    if neighbourhoods is not None:
        out["graph"] = composition.neighbourhood_test(neighbourhoods, radius, "sample", reference)
    out["consensus"] = ranktests.da_consensus(reduce(DataFrame.unionByName, one))
    return out


def signalling(data: Dataset, group: str, pairs: DataFrame, *, condition: str | None = None, methods: tuple[str, ...] = communication.DEFAULT, least_share: float = 0.1, n_perms: int = 1000, seed: int = 42, levels: DataFrame | None = None, sources: list[str] | None = None, targets: list[str] | None = None, scope: str = "all", lookup: DataFrame | None = None) -> dict[str, DataFrame]:
    """Ligand-receptor scores between groups: ``scores``, ``summary`` and ``routes``. Without a condition all methods, the
    permutation p-values and the robust ranks; with one the scores of every level (and context of ``A@B``). ``levels``
    (cluster, level) with ``sources`` and ``targets`` leave events across datasets, ``scope`` secreted ones."""
    layer = qc.lognorm(data.layer())
    if condition:
        scores = signals.scores_by_condition(layer, data.obs, group, pairs, condition, least_share)
    else:
        scores = communication.pair_scores(layer, data.obs, group, pairs, least_share)
        scores = communication.specificities(scores, layer, data.obs, group, pairs)
        if "cellphonedb" in methods:
            scores = communication.permuted_pvals(scores, layer, data.obs, group, pairs, n_perms=n_perms, seed=seed)
        scores = materialise(scores)
        scores = scores.join(communication.robust_ranks(scores, methods), communication.EVENT)
    if levels is not None:
        scores = signals.cross_scope(scores, levels, sources or [], targets or [], scope, lookup)
    by = ["context", "level"] * bool(condition)
    routed = signals.routed(scores.drop("route_family", "route_annotation"), lookup)
    order = [("specificity_rank", True), ("magnitude_rank", True), ("lrscore", False)]
    return {
        "scores": ranking.sort_results(scores, order, communication.EVENT), "summary": scores.groupBy(*by, "source", "target").agg(F.count("*").alias("n"), F.avg("lrscore").alias("mean_score")),
        "routes": routed.groupBy(*by, "source", "route_family").agg(F.count("*").alias("n")),
    }


def _effects(scored: DataFrame, obs: DataFrame, sample: str, condition: str, pair: tuple[str, str], least: int) -> DataFrame:
    levels = obs.groupBy(sample).agg(F.min(F.col(condition).cast("string")).alias("_level"))
    return tasks.paired_effects(scored.join(F.broadcast(levels), sample), ["event"], "_level", "score", *pair, least)


def paired_signalling(data: Dataset, group: str, sample: str, condition: str, pair: tuple[str, str], events: DataFrame, display: DataFrame, *, allow: dict[str, list[str]] | None = None, limit: int = 200, least_cells: int = 3, least_share: float = 0.1, least_samples: int = 2, lookup: DataFrame | None = None) -> dict[str, DataFrame]:
    """Candidate events rescored in every sample: ``events``, ``scores``, ``missing``, ``effects`` of one level against the
    other, and ``routes`` (events and mean difference by route family)."""
    from pyspark.sql import Window

    chosen = signals.candidate_events(signals.normalise_events(events, display, lookup), allow, limit=limit)
    order = Window.partitionBy(F.lit(0)).orderBy("source_token", "target_token", "ligand", "receptor")  # at most ``limit`` events
    chosen = materialise(chosen.withColumn("event", F.row_number().over(order).cast("long")))
    asked = chosen.select("event", F.col("source_token").alias("source"), F.col("target_token").alias("target"), "ligand", "receptor")
    scored = materialise(communication.paired_rescore(data.layer(), data.obs, asked, sample, group, least_cells=least_cells, least_share=least_share))
    effects = _effects(scored, data.obs, sample, condition, pair, least_samples)
    routes = effects.join(F.broadcast(chosen.select("event", "route_family")), "event").groupBy("route_family").agg(F.count("*").alias("n_events"), F.avg("delta").alias("mean_delta"), F.sum((F.col("padj") < 0.05).cast("long")).alias("n_significant"))
    return {"events": chosen, "scores": scored, "missing": communication.missingness(scored), "effects": effects, "routes": routes}


def paired_metabolites(data: Dataset, group: str, sample: str, condition: str, pair: tuple[str, str], events: DataFrame, *, method: str = signals.PROXY, estimates: DataFrame | None = None, annotation: DataFrame | None = None, least_senders: int = 3, least_receivers: int = 3, least_samples: int = 2) -> dict[str, DataFrame]:
    """Metabolite events rescored in every sample: ``scores``, ``effects`` and, with an ``annotation`` (metabolite, class),
    ``classes``."""
    scored = materialise(signals.metabolite_rescore(data.layer(), data.obs, data.var, events, sample, group, method=method, estimates=estimates, least_senders=least_senders, least_receivers=least_receivers))
    out = {"scores": scored, "effects": _effects(scored, data.obs, sample, condition, pair, least_samples)}
    if annotation is not None:
        one = annotation.groupBy("metabolite").agg(F.min("class").alias("class"))
        out["classes"] = signals.annotation_summary(scored.join(F.broadcast(one), "metabolite", "left"), "class", "score")
    return out


def ligand_targets(data: Dataset, group: str, sender: str, receiver: str, pairs: DataFrame, targets: DataFrame, *, geneset: DataFrame | None = None, level: str | None = None, pair: tuple[str, str] | None = None, alpha: float = 0.05, least_gap: float = 0.1, least_share: float = 0.1, n_ligands: int = 30, n_targets: int = 200) -> dict[str, DataFrame]:
    """Ligands of a sender that explain a receiver's genes: ``geneset`` (given, or the genes that respond in the receiver to
    one level against the other), ``activities`` and ``links``. ``targets`` has (ligand, gene_id, score)."""
    if geneset is None:
        layer, obs = qc.lognorm(data.layer()), data.obs.where(F.col(group) == receiver)
        tests = ranktests.wilcoxon_levels(layer, obs, group, level, *pair)
        geneset = materialise(tasks.receiver_genes(tests, group, alpha, least_gap).select("gene_id"))
    activities, links = signals.sender_focused(data.layer(), data.obs, group, sender, receiver, pairs, targets, geneset, least_share=least_share, n_ligands=n_ligands, n_targets=n_targets)
    return {"geneset": geneset, "activities": ranking.sort_results(activities, [("activity", False)], ["ligand"]), "links": links}


METHODS = {"ulm": enrichment.univariate, "mlm": enrichment.multivariate, "wsum": enrichment.weighted_sum}


def activities(matrix: DataFrame, net: DataFrame, group: str, methods: tuple[str, ...] = ("ulm",), top: int = 50) -> DataFrame:
    """(group, source, score) by one method, or the mean of several where all give a score."""
    found = [(enrichment.aucell(matrix, net, group, top) if m == "aucell" else METHODS[m](matrix, net, group)).withColumn("method", F.lit(m)) for m in methods]
    return found[0].drop("method") if len(found) == 1 else enrichment.consensus(reduce(DataFrame.unionByName, found), group, len(methods))


def _nets(data_genes: DataFrame, spark, paths: list[str], least: int) -> DataFrame:
    """All files' sets as one net, a set named ``<file>::<set>``."""
    nets = [files.read_gmt(spark, p).withColumn("source", F.concat(F.lit(p.rsplit("/", 1)[-1].rsplit(".gmt", 1)[0] + "::"), "source")) for p in paths]
    return materialise(enrichment.prepare(reduce(DataFrame.unionByName, nets), data_genes, least))


def enrich_clusters(data: Dataset, group: str, paths: list[str], *, condition: str | None = None, methods: tuple[str, ...] = ("ulm",), gene_filter: list[str] | None = None, least: int = 5, round_id: str | None = None) -> dict[str, DataFrame]:
    """Activities of gene sets on mean expression by group, or by group and condition: ``activity`` and ``families``, under
    a round's id if one is named, so that tables of rounds can stand together."""
    obs = data.obs
    if condition:
        obs = obs.withColumn("_group", F.concat_ws("__", F.col(group).cast("string"), conditions.parse(condition).column())).where(F.col(group).isNotNull())
    else:
        obs = obs.withColumn("_group", F.col(group).cast("string")).where("_group is not null")
    var = genes.filter_genes(data.var, gene_filter or [])
    mean = pseudobulk.means(qc.lognorm(data.layer()).join(var.select("gene_id"), "gene_id", "left_semi"), obs, "_group").select("_group", "gene_id", F.col("mean").alias("value"))
    grid = obs.select("_group").distinct().crossJoin(F.broadcast(var.select("gene_id")))  # groups by genes, as the models ask for
    dense = materialise(grid.join(mean, ["_group", "gene_id"], "left").withColumn("value", F.coalesce("value", F.lit(0.0))))
    net = _nets(var.select("gene_id"), data.obs.sparkSession, paths, least)
    found = activities(dense, net, "_group", methods).withColumnRenamed("_group", "group").withColumn("family", enrichment.family(F.col("source")))
    if round_id:
        found = found.withColumn("round_id", F.lit(round_id))
    return {"activity": found, "families": found.groupBy("family").agg(F.countDistinct("source").alias("n_sets"), F.avg("score").alias("mean_score"))}


def enrich_results(results: DataFrame, paths: list[str], *, cluster: str = "cluster", gene: str = "gene", stats: tuple[str, ...] = ("stat", "log2FoldChange", "cell_wilcoxon_score", "cell_wilcoxon_logfc", "score"), methods: tuple[str, ...] = ("ulm",), permutations: int = 1000, alpha: float = 0.05, least: int = 5, most: int = 500) -> dict[str, DataFrame]:
    """Activities and preranked enrichment of result tables, and both joined: ``activity``, ``gsea``, ``joint``."""
    spark = results.sparkSession
    numbers = results.select(F.col(cluster).cast("string").alias("cluster"), F.col(gene).alias("gene"), *(F.expr(f"try_cast(`{c}` as double)").alias(c) for c in stats if c in results.columns))
    matrix = materialise(pseudobulk.stat_matrix(numbers, "cluster", "gene", list(stats)).select("cluster", F.col("gene").alias("gene_id"), F.col("stat").alias("value")))
    net = _nets(matrix.select("gene_id").distinct(), spark, paths, least)
    activity = activities(matrix, net, "cluster", methods)
    ranked = kernels.gsea(matrix.withColumnRenamed("value", "stat"), net, "cluster", permutations, least, most)
    ranked = benjamini_hochberg(ranked, "pval", ("cluster",), tie=("source",)).withColumn("direction", F.when(F.col("nes") >= 0, "up").otherwise("down"))
    both = enrichment.joint(activity.withColumnRenamed("source", "pathway"), ranked.withColumnRenamed("source", "pathway"), alpha)
    return {"activity": activity, "gsea": ranked, "joint": both.orderBy(F.desc("joint_rank"), "cluster", "pathway")}


def enrich_result_folder(spark, folder: str, paths: list[str], source: str = "auto", **options) -> dict[str, DataFrame]:
    """``enrich_results`` of a folder's tables: ``pseudobulk``, ``cell``, or ``auto``, pseudobulk ones if there are any.
    Clusters are named with their condition and contrast."""
    if source not in ("auto", "pseudobulk", "cell"):
        raise ValueError(f"a source is auto, pseudobulk or cell, not {source!r}")
    readers = {"pseudobulk": files.read_pseudobulk_folder, "cell": files.read_cell_folder}
    for name in ("pseudobulk", "cell") if source == "auto" else (source,):
        try:
            tables = readers[name](spark, folder)
        except Exception as error:  # a path that matches nothing
            if source != "auto" or "PATH_NOT_FOUND" not in str(error):
                raise
            continue
        if "gene" in tables.columns and tables.limit(1).count():
            named = tables.withColumn("cluster", F.concat_ws("|", "condition_key", "contrast", "cluster"))
            return enrich_results(named, paths, **options)
    raise FileNotFoundError(f"{folder}: no result tables")


def select_resolution(curve: DataFrame, *, stability: float = 0.6, share: float = 0.97) -> dict[str, DataFrame]:
    """The plateaus of a resolution curve (resolution, stability, score) and the least resolution near the best score."""
    return {"plateaus": ranking.plateaus(curve, "resolution", F.col("stability") >= stability), "chosen": ranking.parsimonious(curve, "resolution", "score", share)}


def compact_clusters(views: DataFrame, cells: DataFrame, cluster: str, label: str, how: str = "components") -> dict[str, DataFrame]:
    """Clusters that all views find alike, merged: ``judged``, ``codes`` and ``labels`` of the cells."""
    known = cells.withColumn("_label", selection.known_label(F.col(label)))
    top = known.groupBy(cluster, "_label").count().groupBy(cluster).agg(F.min_by("_label", F.struct(-F.col("count"), F.col("_label"))).alias("label"), F.sum("count").alias("n_cells"))
    labels = materialise(top.select(F.col(cluster).cast("string").alias("cluster"), "label", "n_cells"))
    judged = materialise(selection.compaction_views(views, labels))
    codes = selection.compacted_round(judged, labels, how)
    return {"judged": judged, "codes": codes, "labels": cells.select("cell_id", F.col(cluster).cast("string").alias("cluster")).join(F.broadcast(codes), "cluster").select("cell_id", F.col("code").alias("cluster_id"))}


def merge_tokens(parts: dict[str, Dataset], tokens: DataFrame, label: str, how: str = "outer") -> tuple[dict[str, Dataset], DataFrame]:
    """Datasets cut to the clusters that ``tokens`` (dataset, token) name, and new Cnn ids of their composite labels by
    size. A dataset without a token stays whole; a token that means no cluster, or several, is an error."""
    cut = {}
    for name, data in parts.items():
        asked = tokens.where(F.col("dataset") == name).select("token").distinct()
        if asked.limit(1).count():
            codes = data.obs.select(F.col(label).alias("label")).distinct().withColumn("cluster", F.col("label"))
            found = merge.resolve_tokens(asked, codes)
            if wrong := [r["token"] for r in found.where("n_matches != 1").orderBy("token").limit(5).collect()]:
                raise ValueError(f"{name}: tokens that mean no cluster or several: {wrong}")
            data = data.subset(data.obs.join(F.broadcast(found.select(F.col("cluster").alias(label))), label, "left_semi"))
        cut[name] = data
    named = reduce(DataFrame.unionByName, [d.obs.select(F.concat_ws(": ", F.lit(n), F.col(label).cast("string")).alias("composite")) for n, d in cut.items()])
    return cut, merge.relabel_by_size(named, "composite")


def filter_and_prepare(data: Dataset, subsets: dict[str, Column], *, sample: str = "sample_id", n_genes: int = 2000, batch: str | None = None, **cuts) -> dict[str, object]:
    """The filtering cascade, then variable genes of the filtered cells: ``dataset``, ``cells`` (all, judged), ``variable``."""
    from .api import load_and_filter

    kept, judged = load_and_filter(data, subsets, sample=sample, **cuts)
    qc.require_rows(kept.obs, "the filter cascade")
    variable = qc.dispersion_genes(qc.lognorm(kept.layer()), kept.obs, n_genes, batch)
    return {"dataset": kept, "cells": judged, "variable": variable}
