"""Gene-set networks: preparation, activity methods, running-sum enrichment, module scores."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ranked
from ..sources.lineage import materialise


def prepare(net: DataFrame, genes: DataFrame, least: int = 5) -> DataFrame:
    """Edges (source, target, weight) over known genes, weights of repeated edges averaged, sources with enough targets."""
    common = net.join(genes.select(F.col("gene_id").alias("target")).distinct(), "target", "left_semi").groupBy("source", "target").agg(F.avg("weight").alias("weight"))
    big = common.groupBy("source").agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select("source")
    return common.join(big, "source", "left_semi")


def _met(matrix: DataFrame, net: DataFrame, group: str) -> DataFrame:
    return matrix.join(net, matrix["gene_id"] == net["target"]).select(group, "source", "weight", "value")


def weighted_sum(matrix: DataFrame, net: DataFrame, group: str) -> DataFrame:
    """Sum of weight times value over a source's targets."""
    return _met(matrix, net, group).groupBy(group, "source").agg(F.sum(F.col("weight") * F.col("value")).alias("score"))


def univariate(matrix: DataFrame, net: DataFrame, group: str) -> DataFrame:
    """t-value of the slope of values on weights over all genes of the matrix, genes outside a set as weight 0.

    From the sums of a source's targets and of all genes alone; the dense gene x source grid isn't formed.
    ``matrix`` (group, gene_id, value) is dense: every gene in every group. Sets or values that don't vary, and a
    perfect fit, have no t-value and no row.
    """
    every = matrix.groupBy(group).agg(F.count("*").cast("double").alias("n"), F.sum("value").alias("sy"), F.sum(F.col("value") * F.col("value")).alias("syy"))
    part = _met(matrix, net, group).groupBy(group, "source").agg(F.sum("weight").alias("sx"), F.sum(F.col("weight") * F.col("weight")).alias("sxx"), F.sum(F.col("weight") * F.col("value")).alias("sxy"))
    met = part.join(every, group)
    xy = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    xx = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    yy = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    r = F.try_divide(xy, F.sqrt(F.greatest(xx * yy, F.lit(0.0))))
    t = r * F.sqrt(F.try_divide(F.col("n") - 2, (1.0 - r) * (1.0 + r)))
    return met.select(group, "source", t.alias("score")).where("score is not null and not isnan(score)")


def oriented(net: DataFrame, genes: DataFrame) -> DataFrame:
    """The net with genes as targets: source and target change places where more of the sources are genes."""
    known = genes.select(F.col("gene_id").alias("_g")).distinct()
    hits = [net.select(F.col(c).alias("_g")).distinct().join(known, "_g", "left_semi").count() for c in ("source", "target")]
    if hits[0] <= hits[1]:
        return net
    return net.select(F.col("target").alias("source"), F.col("source").alias("target"), *(c for c in net.columns if c not in ("source", "target")))


def multivariate(matrix: DataFrame, net: DataFrame, group: str) -> DataFrame:
    """t-values of all sources' weights in one linear model per group over all genes of the matrix, with a constant.

    The model matrix is the same for all groups, so its normal matrix comes from the net alone (sources by sources, on
    the driver); what depends on the group are sums over its genes, in SQL, and one product a group. Sources that follow
    from the others share their effect by the pseudo-inverse. ``matrix`` (group, gene_id, value) is dense.
    """
    genes = matrix.select("gene_id").distinct()
    n = genes.count()
    held = net.join(genes.withColumnRenamed("gene_id", "target"), "target", "left_semi").groupBy("source", "target").agg(F.sum("weight").cast("double").alias("weight"))
    sums = {r["source"]: r["s"] for r in held.groupBy("source").agg(F.sum("weight").alias("s")).collect()}  # a row a source
    names = sorted(sums)
    place = {s: k + 1 for k, s in enumerate(names)}
    normal = np.zeros((len(names) + 1, len(names) + 1))
    normal[0, 0] = n
    normal[0, 1:] = normal[1:, 0] = [sums[s] for s in names]
    for r in held.alias("x").join(held.toDF("_s", "target", "_w").alias("y"), "target").groupBy("source", "_s").agg(F.sum(F.col("weight") * F.col("_w")).alias("p")).collect():  # sources by sources
        normal[place[r["source"]], place[r["_s"]]] = r["p"]
    inverse, left = np.linalg.pinv(normal), n - np.linalg.matrix_rank(normal)
    every = matrix.groupBy(group).agg(F.sum("value").cast("double").alias("sy"), F.sum(F.col("value").cast("double") * F.col("value")).alias("syy"))
    part = _met(matrix, held, group).groupBy(group, "source").agg(F.sum(F.col("weight") * F.col("value")).alias("xy"))
    kind = matrix.schema[group].dataType.simpleString()

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        right = np.zeros(len(names) + 1)
        right[0] = rows["sy"].iloc[0]
        for source, xy in zip(rows["source"], rows["xy"], strict=True):
            right[place[source]] = xy
        beta = inverse @ right
        rest = max(0.0, float(rows["syy"].iloc[0] - beta @ right))
        error = np.sqrt(np.maximum(np.diag(inverse) * rest / max(left, 1), 0))[1:]
        score = np.divide(beta[1:], error, out=np.full(len(names), np.nan), where=error > 0)
        return pd.DataFrame({group: rows[group].iloc[0], "source": names, "score": score})

    return part.join(every, group).groupBy(group).applyInPandas(solve, f"`{group}` {kind}, source string, score double").where("not isnan(score)")


def aucell(matrix: DataFrame, net: DataFrame, group: str, top: int) -> DataFrame:
    """Area under the recovery curve of a set's genes among the ``top`` of each group, over the greatest possible."""
    order = Window.partitionBy(group).orderBy(F.desc("value"), "gene_id")
    ranked = matrix.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= top)
    size = net.groupBy("source").agg(F.count("*").alias("k"))
    hit = ranked.join(net.select(F.col("target").alias("gene_id"), "source"), "gene_id").groupBy(group, "source").agg(F.sum(F.lit(top) - F.col("_rank") + 1).alias("area"))
    m = F.least("k", F.lit(top))
    return hit.join(size, "source").select(group, "source", F.try_divide(F.col("area").cast("double"), m * top - m * (m - 1) / 2).alias("score"))


def consensus(scores: DataFrame, group: str, methods: int) -> DataFrame:
    """Mean over methods where all of them give a score. ``scores`` has (group, source, method, score)."""
    return scores.groupBy(group, "source").agg(F.avg("score").alias("score"), F.countDistinct("method").alias("_n")).where(F.col("_n") == methods).drop("_n")


def family(term: Column) -> Column:
    """The family of a term: what stands before ``::``, else before the first underscore."""
    return F.when(term.contains("::"), F.substring_index(term, "::", 1)).otherwise(F.substring_index(term, "_", 1))


def running_sum(stats: DataFrame, net: DataFrame, group: str, low: int = 10, high: int = 500) -> DataFrame:
    """Preranked enrichment: the greatest deviation of the running sum, weights |stat|, and the leading edge's size.

    Genes are ranked by stat descending (ties: gene id). Between hits the sum falls linearly, so only its
    values at and just before hits matter: the windows run over a set's genes, not over genes x sets. A set that
    covers the whole list, or whose genes all have stat 0, has no running sum and no row.
    """
    order = Window.partitionBy(group).orderBy(F.desc("stat"), "gene_id")
    ranked = stats.withColumn("_rank", F.row_number().over(order)).withColumn("_n", F.count("*").over(Window.partitionBy(group)))
    hits = ranked.join(net.select(F.col("target").alias("gene_id"), "source").distinct(), "gene_id")
    by = Window.partitionBy(group, "source")
    upto = by.orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    sized = hits.withColumn("_k", F.count("*").over(by)).where((F.col("_k") >= low) & (F.col("_k") <= high) & (F.col("_k") < F.col("_n")))
    weighted = sized.withColumn("_w", F.sum(F.abs("stat")).over(by)).withColumn("_c", F.sum(F.abs("stat")).over(upto)).withColumn("_i", F.row_number().over(by.orderBy("_rank")))
    weighted = weighted.where("_w > 0")
    miss = (F.col("_rank") - F.col("_i")) / (F.col("_n") - F.col("_k"))
    at = F.col("_c") / F.col("_w") - miss
    before = (F.col("_c") - F.abs("stat")) / F.col("_w") - miss
    best = weighted.groupBy(group, "source").agg(F.max(at).alias("_hi"), F.min(before).alias("_lo"), F.max("_k").alias("size"))
    return best.select(group, "source", F.col("size").cast("long").alias("size"), F.when(F.col("_hi") >= -F.col("_lo"), F.col("_hi")).otherwise(F.col("_lo")).alias("es"))


def leading_preview(edge: Column, n: int) -> Column:
    """The first n genes of a list split at semicolons or commas, joined, and how many there are."""
    genes = F.filter(F.transform(F.split(edge, "[;,]"), lambda g: F.trim(g)), lambda g: g != "")
    return F.struct(F.array_join(F.slice(genes, 1, n), ", ").alias("preview"), F.size(genes).cast("long").alias("n"))


def joint(activity: DataFrame, gsea: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Activities joined with enrichment by (cluster, pathway): sign concordance, support by both, and a joint
    rank score, 1e6 both + 1e5 concordant + 1e4 significant + (1e4 - rank of |score|) + (1e4 - rank of |NES|),
    with dense ranks over all rows."""
    met = activity.join(gsea, ["cluster", "pathway"])
    same = F.signum("score") == F.signum("nes")
    sig = F.coalesce(F.col("padj") < alpha, F.lit(False))
    out = materialise(met.withColumn("sign_concordant", same).withColumn("supported_by_both", same & sig).withColumn("_sig", sig))
    out = ranked(out, (-F.round(F.abs("score"), 9), "_r1", True), (-F.round(F.abs("nes"), 9), "_r2", True))
    points = 1_000_000 * F.col("supported_by_both").cast("long") + 100_000 * F.col("sign_concordant").cast("long") + 10_000 * F.col("_sig").cast("long") + (10_000 - F.col("_r1")) + (10_000 - F.col("_r2"))
    return out.withColumn("joint_rank", points.cast("long")).drop("_sig", "_r1", "_r2")


def module_score(layer: DataFrame, obs: DataFrame, module: list[str], *, bins: int = 5, controls: int = 4, seed: str = "0") -> DataFrame:
    """Per cell the mean of a module's genes less that of control genes, zeros included.

    Controls are, for each expression bin that holds module genes, the first ``controls`` other genes in order
    of an md5 of seed and gene.
    """
    n = F.broadcast(obs.agg(F.count("*").alias("_n")))
    mean = layer.groupBy("gene_id").agg(F.sum("value").alias("_s")).crossJoin(n).withColumn("_m", F.col("_s") / F.col("_n"))
    binned = mean.withColumn("bin", F.ntile(bins).over(Window.partitionBy(F.lit(0)).orderBy("_m", "gene_id")))
    mine = F.col("gene_id").isin(module)
    used = binned.where(mine).select("bin").distinct()
    order = Window.partitionBy("bin").orderBy(F.md5(F.concat_ws("|", F.lit(seed), "gene_id")), "gene_id")
    drawn = binned.where(~mine).join(F.broadcast(used), "bin", "left_semi").withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= controls).select("gene_id", F.lit(0).alias("_in"))
    genes = binned.where(mine).select("gene_id", F.lit(1).alias("_in")).unionByName(drawn)
    sizes = genes.agg(F.sum("_in").alias("_a"), F.sum(1 - F.col("_in")).alias("_b"))
    sums = layer.join(F.broadcast(genes), "gene_id").groupBy("cell_id").agg(F.sum(F.when(F.col("_in") == 1, F.col("value")).otherwise(0.0)).alias("_x"), F.sum(F.when(F.col("_in") == 0, F.col("value")).otherwise(0.0)).alias("_y"))
    return obs.select("cell_id").join(sums, "cell_id", "left").crossJoin(F.broadcast(sizes)).select("cell_id", (F.coalesce(F.try_divide(F.coalesce("_x", F.lit(0.0)), F.col("_a")), F.lit(0.0)) - F.coalesce(F.try_divide(F.coalesce("_y", F.lit(0.0)), F.col("_b")), F.lit(0.0))).alias("score"))


def module_scores(layer: DataFrame, obs: DataFrame, modules: DataFrame, *, bins: int = 5, controls: int = 4, seed: str = "0") -> DataFrame:
    """``module_score`` of every module of a table (source, target) at once: (cell_id, source, score) of all cells and
    modules, from one pass over the layer. Modules without a gene of the layer score 0."""
    n = obs.agg(F.count("*").alias("_n"))
    mean = layer.groupBy("gene_id").agg(F.sum("value").alias("_s")).crossJoin(n).withColumn("_m", F.col("_s") / F.col("_n"))
    binned = materialise(mean.select("gene_id", F.ntile(bins).over(Window.partitionBy(F.lit(0)).orderBy("_m", "gene_id")).alias("bin")))  # genes, not cells
    mine = modules.select("source", F.col("target").alias("gene_id")).distinct().join(binned, "gene_id")
    used = mine.select("source", "bin").distinct()
    order = Window.partitionBy("source", "bin").orderBy(F.md5(F.concat_ws("|", F.lit(seed), "gene_id")), "gene_id")
    others = used.join(binned, "bin").join(mine.select("source", "gene_id"), ["source", "gene_id"], "left_anti")
    drawn = others.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= controls).select("source", "gene_id", F.lit(0).alias("_in"))
    genes = materialise(mine.select("source", "gene_id", F.lit(1).alias("_in")).unionByName(drawn))
    sizes = genes.groupBy("source").agg(F.sum("_in").alias("_a"), F.sum(1 - F.col("_in")).alias("_b"))
    side = lambda k: F.sum(F.when(F.col("_in") == k, F.col("value")).otherwise(0.0))
    sums = layer.join(genes, "gene_id").groupBy("cell_id", "source").agg(side(1).alias("_x"), side(0).alias("_y"))
    grid = obs.select("cell_id").crossJoin(F.broadcast(modules.select("source").distinct()))  # modules are a dimension
    met = grid.join(sums, ["cell_id", "source"], "left").join(sizes, "source", "left")
    share = lambda s, k: F.coalesce(F.try_divide(F.coalesce(s, F.lit(0.0)), F.col(k)), F.lit(0.0))
    return met.select("cell_id", "source", (share("_x", "_a") - share("_y", "_b")).alias("score"))
