"""Rank-sum, t and sign statistics on long triples, with the zeros in closed form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import normal_two_sided


def wilcoxon(layer: DataFrame, obs: DataFrame, group: str, *, pseudocount: float = 1e-9) -> DataFrame:
    """Per (group, gene) the rank-sum score of the group against the rest, its p-value, log2 fold change of means
    of expm1, and prevalence on both sides.

    Only stored, positive values are ranked: of N cells, N - nnz zeros tie below them with the mean rank
    (zeros + 1) / 2, so the group's rank sum is (zeros in the group) times that plus the sum of its values'
    ranks, each moved up by the number of zeros. Variance without tie correction, normal approximation.
    """
    sizes = obs.groupBy(group).agg(F.count("*").cast("double").alias("n1"))
    total = obs.agg(F.count("*").cast("double").alias("n"))
    values = layer.where("value > 0").join(obs.select("cell_id", group), "cell_id")
    by = Window.partitionBy("gene_id")
    ties = Window.partitionBy("gene_id", "value")
    ranked = values.withColumn("_rank", F.rank().over(by.orderBy("value")) + (F.count("*").over(ties) - 1) / 2.0).withColumn("_nnz", F.count("*").over(by).cast("double"))
    per = ranked.groupBy("gene_id", group).agg(F.sum("_rank").alias("_r"), F.count("*").cast("double").alias("_k"), F.max("_nnz").alias("_nnz"), F.sum(F.expm1("value")).alias("_s"))
    sums = values.groupBy("gene_id").agg(F.sum(F.expm1("value")).alias("_all"))
    grid = per.join(F.broadcast(sizes), group).join(sums, "gene_id").crossJoin(F.broadcast(total))
    zeros = F.col("n") - F.col("_nnz")
    rank_sum = F.col("_r") + F.col("_k") * zeros + (F.col("n1") - F.col("_k")) * (zeros + 1) / 2
    n2 = F.col("n") - F.col("n1")
    z = (rank_sum - F.col("n1") * (F.col("n") + 1) / 2) / F.sqrt(F.col("n1") * n2 * (F.col("n") + 1) / 12)
    mean, rest = F.col("_s") / F.col("n1"), (F.col("_all") - F.col("_s")) / n2
    return grid.select(group, "gene_id", z.alias("score"), normal_two_sided(z).alias("pval"), F.log2((mean + pseudocount) / (rest + pseudocount)).alias("lfc"), (F.col("_k") / F.col("n1")).alias("pts"), ((F.col("_nnz") - F.col("_k")) / n2).alias("pts_rest"))


def wilcoxon_levels(layer: DataFrame, obs: DataFrame, context: str, level: str, a: str, b: str) -> DataFrame:
    """Level a against level b within each context, as one plan: a context's genes are genes of its own."""
    cells = obs.where(F.col(level).isin(a, b))
    sizes = cells.groupBy(context).agg(F.sum((F.col(level) == a).cast("double")).alias("n1"), F.sum((F.col(level) == b).cast("double")).alias("n2")).where("n1 > 0 and n2 > 0")
    values = layer.where("value > 0").join(cells.select("cell_id", context, level), "cell_id")
    by, ties = Window.partitionBy(context, "gene_id"), Window.partitionBy(context, "gene_id", "value")
    ranked = values.withColumn("_rank", F.rank().over(by.orderBy("value")) + (F.count("*").over(ties) - 1) / 2.0).withColumn("_nnz", F.count("*").over(by).cast("double"))
    mine = F.col(level) == a
    per = ranked.groupBy(context, "gene_id").agg(F.sum(F.when(mine, F.col("_rank")).otherwise(0.0)).alias("_r"), F.sum(mine.cast("double")).alias("_k"), F.max("_nnz").alias("_nnz"))
    met = per.join(F.broadcast(sizes), context)
    n = F.col("n1") + F.col("n2")
    zeros = n - F.col("_nnz")
    rank_sum = F.col("_r") + F.col("_k") * zeros + (F.col("n1") - F.col("_k")) * (zeros + 1) / 2
    z = (rank_sum - F.col("n1") * (n + 1) / 2) / F.sqrt(F.col("n1") * F.col("n2") * (n + 1) / 12)
    return met.select(context, "gene_id", z.alias("score"), normal_two_sided(z).alias("pval"), (F.col("_k") / F.col("n1")).alias("pct_a"), ((F.col("_nnz") - F.col("_k")) / F.col("n2")).alias("pct_b"))


def t_test(layer: DataFrame, obs: DataFrame, group: str) -> DataFrame:
    """Welch's t of the group against the rest per gene, zeros included, with its degrees of freedom."""
    sizes = obs.groupBy(group).agg(F.count("*").cast("double").alias("n1"))
    total = obs.agg(F.count("*").cast("double").alias("n"))
    part = layer.join(obs.select("cell_id", group), "cell_id").groupBy(group, "gene_id").agg(F.sum("value").alias("_s"), F.sum(F.col("value") * F.col("value")).alias("_q"))
    both = Window.partitionBy("gene_id")
    met = part.withColumn("_s_all", F.sum("_s").over(both)).withColumn("_q_all", F.sum("_q").over(both)).join(F.broadcast(sizes), group).crossJoin(F.broadcast(total))
    n2 = F.col("n") - F.col("n1")
    m1, m2 = F.col("_s") / F.col("n1"), F.try_divide(F.col("_s_all") - F.col("_s"), n2)
    v1 = F.try_divide(F.col("_q") - F.col("n1") * m1 * m1, (F.col("n1") - 1) * F.col("n1"))
    v2 = F.try_divide(F.col("_q_all") - F.col("_q") - n2 * m2 * m2, (n2 - 1) * n2)
    return met.select(group, "gene_id", F.try_divide(m1 - m2, F.sqrt(v1 + v2)).alias("t"), F.try_divide((v1 + v2) * (v1 + v2), v1 * v1 / (F.col("n1") - 1) + v2 * v2 / (n2 - 1)).alias("df"))


def consensus_tiers(rows: DataFrame, *, alpha: float = 0.05, lfc: float = 0.25, coef: float = 0.25, pb: float = 0.5, with_pseudobulk: bool = True) -> DataFrame:
    """Hits of three methods, the tier they give and a score.

    ``rows`` has wilcoxon_lfc, wilcoxon_padj, logreg_coef, pb_lfc and ok (the prevalence filter).
    """
    w = F.coalesce((F.col("wilcoxon_padj") < alpha) & (F.abs("wilcoxon_lfc") >= lfc) & F.col("ok"), F.lit(False))
    g = F.coalesce(F.abs("logreg_coef") >= coef, F.lit(False))
    p = F.coalesce(F.abs("pb_lfc") >= pb, F.lit(False)) if with_pseudobulk else F.lit(False)
    out = rows.withColumn("hits", w.cast("long") + g.cast("long") + p.cast("long"))
    same = F.coalesce((F.signum("wilcoxon_lfc") == F.signum("pb_lfc")) & (F.signum("wilcoxon_lfc") == F.signum("logreg_coef")), F.lit(False))
    first, second = ((F.col("hits") == 3) & same, F.col("hits") >= 2) if with_pseudobulk else (F.col("hits") >= 2, F.col("hits") >= 1)
    tier = F.when(first, "Tier1").when(second, "Tier2")
    tier = tier.when(F.col("hits") >= 1, "Tier3") if with_pseudobulk else tier
    out = out.withColumn("tier", tier)
    bonus = F.when(F.col("tier") == "Tier1", 2).when(F.col("tier") == "Tier2", 1).otherwise(0)
    return out.withColumn("score", (F.col("hits") + bonus).cast("long"))


def cliffs_delta(rows: DataFrame, by: list[str], side: str, value: str, a: str, b: str) -> DataFrame:
    """Mean sign of x - y over all pairs of the two sides, by ranks: 2 U / (n1 n2) - 1, so no pair is formed."""
    order = Window.partitionBy(*by)
    kept = rows.where(F.col(side).isin(a, b) & F.col(value).isNotNull())
    ranked = kept.withColumn("_r", F.rank().over(order.orderBy(value)) + (F.count("*").over(Window.partitionBy(*by, value)) - 1) / 2.0)
    part = ranked.groupBy(*by).agg(F.sum(F.when(F.col(side) == a, F.col("_r"))).alias("_s"), F.sum((F.col(side) == a).cast("double")).alias("n_a"), F.sum((F.col(side) == b).cast("double")).alias("n_b")).where("n_a > 0 and n_b > 0")
    u = F.col("_s") - F.col("n_a") * (F.col("n_a") + 1) / 2
    return part.select(*by, F.col("n_a").cast("long").alias("n_a"), F.col("n_b").cast("long").alias("n_b"), (F.try_divide(2 * u, (F.col("n_a") * F.col("n_b")).cast("double")) - 1).alias("delta"), u.alias("u"))


def shrink(effect: Column, n: Column, k: float) -> Column:
    """effect * n / (n + k)."""
    return effect * n / (n + F.lit(k))


def da_consensus(results: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Per (cluster, term) over methods: how many there are, how many are significant, mean effect and sign
    consensus; high confidence if the graph method is significant and another one has its sign."""
    sig = F.coalesce(F.col("fdr") < alpha, F.lit(False))
    of = lambda m: F.max(F.when(F.col("method") == m, F.signum("effect")))
    wide = results.groupBy("cluster", "term").agg(F.count("*").alias("n_methods"), F.sum(sig.cast("long")).alias("n_sig"), F.avg("effect").alias("mean_effect"), F.countDistinct(F.signum("effect")).alias("_signs"), F.max(F.when(F.col("method") == "graph", sig)).alias("_gs"), of("graph").alias("_g"), of("clr").alias("_c"), of("sccoda").alias("_s"))
    agree = F.col("_signs") == 1
    return wide.select("cluster", "term", "n_methods", "n_sig", "mean_effect", agree.alias("sign_agree"), F.coalesce(F.col("_gs") & (F.coalesce(F.col("_c") == F.col("_g"), F.lit(False)) | F.coalesce(F.col("_s") == F.col("_g"), F.lit(False))), F.lit(False)).alias("high_confidence"))


def clr(table: DataFrame, sample: str, share: str = "share", eps: float = 1e-6) -> DataFrame:
    """Centred log-ratio of shares within samples."""
    value = F.log(F.col(share) + eps)
    return table.withColumn("clr", value - F.avg(value).over(Window.partitionBy(sample)))
