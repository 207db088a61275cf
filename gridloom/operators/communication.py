"""Ligand-receptor scoring between groups, paired rescoring by sample, routes and summaries."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ranked
from ..sources.lineage import materialise
from .pseudobulk import means

EVENT = ["source", "target", "ligand", "receptor"]
#: Methods: (magnitude column, less is better, specificity column, less is better).
METHODS = {
    "cellphonedb": ("lr_means", False, "cellphone_pvals", True),
    "connectome": ("expr_prod", False, "scaled_weight", False),
    "natmi": ("expr_prod", False, "spec_weight", False),
    "sca": ("lrscore", False, None, False),
    "logfc": (None, False, "lr_logfc", False),
}


def pair_scores(layer: DataFrame, obs: DataFrame, group: str, pairs: DataFrame, least_share: float = 0.1) -> DataFrame:
    """Scores of every (source, target, ligand, receptor) whose genes enough cells express.

    lr_means: mean of the two means; expr_prod: their product; spec_weight: product of each mean's share of
    its gene's sum over groups; lrscore: sqrt(lr) / (sqrt(lr) + overall mean). Group x gene means are small;
    the pairs' table is broadcast.
    """
    stats = means(layer, obs, group)
    overall = layer.agg(F.sum("value").alias("_s")).crossJoin(obs.agg(F.count("*").alias("_c"))).crossJoin(layer.agg(F.countDistinct("gene_id").alias("_g"))).select((F.col("_s") / (F.col("_c") * F.col("_g"))).alias("mu"))
    spread = stats.withColumn("weight", F.col("mean") / F.sum("mean").over(Window.partitionBy("gene_id"))).where(F.col("fraction") >= least_share)
    left = spread.select(F.col(group).alias("source"), F.col("gene_id").alias("ligand"), F.col("mean").alias("l"), F.col("weight").alias("lw"))
    right = spread.select(F.col(group).alias("target"), F.col("gene_id").alias("receptor"), F.col("mean").alias("r"), F.col("weight").alias("rw"))
    met = left.join(pairs, "ligand").join(right, "receptor").crossJoin(F.broadcast(overall))
    root = F.sqrt(F.col("l") * F.col("r"))
    return met.select("source", "target", "ligand", "receptor", ((F.col("l") + F.col("r")) / 2).alias("lr_means"), (F.col("l") * F.col("r")).alias("expr_prod"), (F.col("lw") * F.col("rw")).alias("spec_weight"), F.try_divide(root, root + F.col("mu")).alias("lrscore"))


#: The methods that are aggregated where none are named.
DEFAULT = ("cellphonedb", "natmi", "sca", "logfc")


def _named(layer: DataFrame, pairs: DataFrame) -> DataFrame:
    genes = pairs.select(F.col("ligand").alias("gene_id")).union(pairs.select("receptor")).distinct()
    return layer.join(genes, "gene_id", "left_semi")


def specificities(scores: DataFrame, layer: DataFrame, obs: DataFrame, group: str, pairs: DataFrame) -> DataFrame:
    """``pair_scores`` with scaled_weight, the mean of both genes' z-scores in the group (over all cells, sample
    deviation), and lr_logfc, the mean of both genes' log2((mean + 1) / (mean over the other cells + 1))."""
    met = _named(layer, pairs).join(obs.select("cell_id", group), "cell_id")
    sizes = obs.groupBy(group).agg(F.count("*").alias("n"))
    per = met.groupBy(group, "gene_id").agg(F.sum("value").cast("double").alias("s")).join(sizes, group)
    every = met.groupBy("gene_id").agg(F.sum("value").cast("double").alias("all"), F.sum(F.col("value").cast("double") * F.col("value")).alias("squares")).crossJoin(obs.agg(F.count("*").alias("cells")))
    mean, centre = F.col("s") / F.col("n"), F.col("all") / F.col("cells")
    spread = F.sqrt(F.greatest(F.lit(0.0), F.try_divide(F.col("squares") - F.col("cells") * centre * centre, F.col("cells") - 1)))
    rest = F.coalesce(F.try_divide(F.col("all") - F.col("s"), F.col("cells") - F.col("n")), F.lit(0.0))
    one = per.join(every, "gene_id").select(group, "gene_id", F.coalesce(F.try_divide(mean - centre, spread), F.lit(0.0)).alias("z"), F.log2((mean + 1) / (rest + 1)).alias("fc"))
    left, right = one.toDF("source", "ligand", "lz", "lfc"), one.toDF("target", "receptor", "rz", "rfc")
    both = scores.join(left, ["source", "ligand"]).join(right, ["target", "receptor"])
    return both.select(*scores.columns, ((F.col("lz") + F.col("rz")) / 2).alias("scaled_weight"), ((F.col("lfc") + F.col("rfc")) / 2).alias("lr_logfc"))


def permuted_pvals(scores: DataFrame, layer: DataFrame, obs: DataFrame, group: str, pairs: DataFrame, *, n_perms: int = 1000, seed: int = 42, buckets: int = 16) -> DataFrame:
    """``pair_scores`` with cellphone_pvals: the share of permutations of the cells' labels whose lr_means reaches
    the observed one. Ids and labels of the cells, 16 bytes each, are broadcast; a task has a bucket of genes, and
    every task draws the same permutations."""
    cells = obs.select("cell_id", F.col(group).cast("string").alias("g")).toPandas().sort_values("cell_id")
    names, codes = np.unique(cells["g"].to_numpy(dtype=str), return_inverse=True)
    shared = obs.sparkSession.sparkContext.broadcast((cells["cell_id"].to_numpy(), codes, names))

    def null(part: pd.DataFrame) -> pd.DataFrame:
        ids, codes, names = shared.value
        genes, gene = np.unique(part["gene_id"].to_numpy(dtype=str), return_inverse=True)
        at, value, k = np.searchsorted(ids, part["cell_id"].to_numpy()), part["value"].to_numpy(dtype=float), len(names)
        sizes = np.tile(np.bincount(codes, minlength=k), len(genes))
        drawn = np.array([np.bincount(gene * k + np.random.default_rng([seed, p]).permutation(codes)[at], weights=value, minlength=k * len(genes)) / sizes for p in range(n_perms)])
        return pd.DataFrame({"g": np.tile(names, len(genes)), "gene_id": np.repeat(genes, k), "means": list(drawn.T)})

    held = _named(layer, pairs).join(obs.select("cell_id"), "cell_id", "left_semi").select("cell_id", "gene_id", F.col("value").cast("double").alias("value"), F.pmod(F.xxhash64("gene_id"), F.lit(buckets)).alias("bucket"))
    means_ = held.groupBy("bucket").applyInPandas(null, "g string, gene_id string, means array<double>")
    left, right = means_.toDF("_s", "ligand", "_l"), means_.toDF("_t", "receptor", "_r")
    met = scores.withColumn("_s", F.col("source").cast("string")).withColumn("_t", F.col("target").cast("string")).join(left, ["_s", "ligand"]).join(right, ["_t", "receptor"])
    reached = F.filter(F.zip_with("_l", "_r", lambda a, b: (a + b) / 2), lambda x: x >= F.col("lr_means") - 1e-9)
    return met.select(*scores.columns, (F.size(reached) / F.lit(n_perms)).alias("cellphone_pvals"))


def robust_ranks(scores: DataFrame, methods: tuple[str, ...] = DEFAULT, key: list[str] = EVENT) -> DataFrame:
    """Robust rank aggregation: magnitude_rank and specificity_rank over the methods' columns. Ranks, ties at their
    mean, are divided by the rows; the least tail of the sorted ranks' order statistics counts, times their number."""
    sides = ([(METHODS[m][at], METHODS[m][at + 1]) for m in methods if METHODS[m][at]] for at in (0, 2))
    sides = [list(columns) for columns in sides]
    asked = sorted({c for columns in sides for c in columns})
    value = {c: F.round(c, 9) * (1 if up else -1) for c, up in asked}
    scores = materialise(scores)
    n = scores.count()
    held = ranked(scores, *((value[c], f"_rank_{c}", False) for c, _ in asked))

    def share(c: str) -> Column:
        return (F.col(f"_rank_{c}") + (F.count("*").over(Window.partitionBy(value[c])) - 1) / 2) / F.lit(n)

    def rho(columns: list[tuple[str, bool]]) -> Column:
        k, ranks = len(columns), F.array_sort(F.array(*(share(c) for c, _ in columns)))
        tail = lambda i: sum((math.comb(k, j) * F.pow(F.get(ranks, F.lit(i - 1)), F.lit(j)) * F.pow(1 - F.get(ranks, F.lit(i - 1)), F.lit(k - j)) for j in range(i, k + 1)), F.lit(0.0))
        return F.least(F.lit(1.0), k * F.array_min(F.array(*(tail(i) for i in range(1, k + 1)))))

    return held.select(*key, *(rho(columns).alias(name) for columns, name in zip(sides, ("magnitude_rank", "specificity_rank"), strict=True)))


def aggregate_ranks(scores: DataFrame, columns: list[tuple[str, bool]], key: list[str]) -> DataFrame:
    """Mean of the normalised ranks by several columns (name, less is better)."""
    scores = materialise(scores)
    n = scores.count()
    held = ranked(scores, *((F.round(c, 9) * (1 if up else -1), f"_rank_{c}", False) for c, up in columns))
    ranks = [F.col(f"_rank_{c}") / F.lit(n) for c, _ in columns]
    return held.select(*key, (sum(ranks[1:], ranks[0]) / len(ranks)).alias("magnitude_rank"))


def summary(events: DataFrame, score: str) -> DataFrame:
    """Events and mean score by (source, target), most first."""
    return events.groupBy("source", "target").agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"))


def gene_family(gene: Column) -> Column:
    """The letters that a gene's name begins with."""
    return F.regexp_extract(gene, "^([A-Za-z]+)", 1)


def route(events: DataFrame, lookup: DataFrame) -> DataFrame:
    """Route of a pair: looked up by the normalised (ligand, receptor), else both genes' families."""
    norm = lambda c: F.upper(F.regexp_replace(c, "[^A-Za-z0-9]", ""))
    side = lookup.groupBy(norm(F.col("ligand")).alias("_l"), norm(F.col("receptor")).alias("_r")).agg(F.min("pathway").alias("_p"))
    met = events.withColumn("_l", norm(F.col("ligand"))).withColumn("_r", norm(F.col("receptor"))).join(side, ["_l", "_r"], "left")
    return met.withColumn("route", F.coalesce("_p", F.concat_ws("-", gene_family(F.col("ligand")), gene_family(F.col("receptor"))))).drop("_l", "_r", "_p")


def cross_filter(events: DataFrame, levels: DataFrame, source_level: str, target_level: str) -> DataFrame:
    """Events whose source's and target's dominant levels (cluster, level) are the ones allowed."""
    of = lambda side, level: levels.where(F.col("level") == level).select(F.col("cluster").alias(side))
    return events.join(of("source", source_level), "source", "left_semi").join(of("target", target_level), "target", "left_semi")


def paired_rescore(layer: DataFrame, obs: DataFrame, events: DataFrame, sample: str, group: str, *, least_cells: int = 3, least_share: float = 0.1) -> DataFrame:
    """Every event rescored in every sample: mean log1p of each complex over the group's cells and genes, zeros
    included; sqrt(ligand x receptor), and the first reason that stands against it.

    Complexes ``A_B`` are exploded to genes; a complex's detection is the least prevalence of its genes.
    """
    cells = obs.groupBy(sample, group).agg(F.count("*").alias("n_cells"))
    per = layer.join(obs.select("cell_id", sample, group), "cell_id").groupBy(sample, group, "gene_id").agg(F.sum(F.log1p("value")).alias("s"), F.count("*").alias("k"))
    base = events.select("event", "source", "target", "ligand", "receptor").crossJoin(F.broadcast(obs.select(sample).distinct()))  # samples are a dimension

    def side(role: str, gene: str) -> DataFrame:
        genes = base.select("event", sample, F.col(role).alias(group), F.explode(F.split(gene, "_")).alias("gene_id"))
        met = genes.join(per, [sample, group, "gene_id"], "left").join(cells, [sample, group], "left")
        return met.groupBy("event", sample).agg(F.coalesce(F.max("n_cells"), F.lit(0)).alias(f"{role}_cells"), (F.sum(F.coalesce("s", F.lit(0.0))) / F.count("*") / F.max("n_cells")).alias(f"{role}_mean"), (F.min(F.coalesce("k", F.lit(0))) / F.max("n_cells")).alias(f"{role}_share"))

    met = base.join(side("source", "ligand"), ["event", sample]).join(side("target", "receptor"), ["event", sample])
    reason = F.when(F.col("source_cells") < least_cells, "sender_cells").when(F.col("target_cells") < least_cells, "receiver_cells").when(F.col("source_share") < least_share, "ligand_detection").when(F.col("target_share") < least_share, "receptor_detection")
    score = F.sqrt(F.greatest("source_mean", F.lit(0.0)) * F.greatest("target_mean", F.lit(0.0)))
    return met.select("event", sample, "source", "target", reason.alias("missing_reason"), F.when(reason.isNull(), F.log1p(score)).alias("score"))


def missingness(scored: DataFrame) -> DataFrame:
    """Per event: samples, scored ones, and those missing by reason."""
    reasons = ("sender_cells", "receiver_cells", "ligand_detection", "receptor_detection")
    return scored.groupBy("event").agg(F.count("*").alias("n_total"), F.count("score").alias("n_scored"), *(F.sum((F.col("missing_reason") == r).cast("long")).alias(f"n_{r}") for r in reasons)).na.fill(0)


def ligand_activity(targets: DataFrame, geneset: DataFrame) -> DataFrame:
    """Pearson correlation of each ligand's target scores (ligand, gene_id, score) with membership in a gene set."""
    marked = targets.join(geneset.select("gene_id", F.lit(1.0).alias("_in")), "gene_id", "left")
    return marked.groupBy("ligand").agg(F.corr("score", F.coalesce("_in", F.lit(0.0))).alias("activity"))


def circos(events: DataFrame, score: str, n: int) -> DataFrame:
    """The top edges, and for nodes without the other role a dummy edge to themselves of value 0."""
    top = events.orderBy(F.desc(F.round(score, 9)), "source", "target").limit(n).select("source", "target", F.col(score).alias("value"))
    senders, receivers = top.select(F.col("source").alias("n")).distinct(), top.select(F.col("target").alias("n")).distinct()
    lone = senders.join(receivers, "n", "left_anti").unionByName(receivers.join(senders, "n", "left_anti"))
    return top.unionByName(lone.select(F.col("n").alias("source"), F.col("n").alias("target"), F.lit(0.0).alias("value")))
