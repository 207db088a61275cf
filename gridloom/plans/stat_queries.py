"""Ranking, multiple testing, rank tests and cluster selection over the views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import pseudobulk, ranking, ranktests, selection
from .registry import query
from .views import Views, r6



def p_sql(z: str) -> str:
    t = f"(1.0::DOUBLE / (1.0::DOUBLE + 0.3275911::DOUBLE * (abs({z}) / 1.4142135623730951::DOUBLE)))"
    poly = f"(((((1.061405429::DOUBLE * {t} + -1.453152027::DOUBLE) * {t} + 1.421413741::DOUBLE) * {t} + -0.284496736::DOUBLE) * {t} + 0.254829592::DOUBLE) * {t})"
    return f"least(1.0::DOUBLE, greatest(0.0::DOUBLE, {poly} * exp(-({z}) * ({z}) / 2.0::DOUBLE)))"


_WILCOX = f"""--with l AS (SELECT cell_id, gene_id, ln(1 + value) AS value FROM counts),
s AS (SELECT cluster_id, count(*)::DOUBLE AS n1 FROM obs GROUP BY 1), t AS (SELECT count(*)::DOUBLE AS n FROM obs),
d AS (SELECT cell_id, cluster_id, gene_id, coalesce(value, 0) AS value FROM (SELECT * FROM obs, (SELECT DISTINCT gene_id FROM l)) LEFT JOIN l USING (cell_id, gene_id)),
r AS (SELECT *, rank() OVER (PARTITION BY gene_id ORDER BY value) + (count(*) OVER (PARTITION BY gene_id, value) - 1) / 2.0::DOUBLE AS rk FROM d),
g AS (SELECT cluster_id, gene_id, sum(rk) AS rs, count(*) FILTER (value > 0) AS k, sum(exp(value) - 1) AS sm FROM r GROUP BY 1, 2),
a AS (SELECT gene_id, sum(k) AS ka, sum(sm) AS sa FROM g GROUP BY 1),
w AS (SELECT cluster_id, gene_id, (rs - n1 * (n + 1) / 2) / sqrt(n1 * (n - n1) * (n + 1) / 12) AS z, log2((sm / n1 + 1e-9) / ((sa - sm) / (n - n1) + 1e-9)) AS lfc, k / n1 AS pts, (ka - k) / (n - n1) AS pts_rest FROM g JOIN a USING (gene_id) JOIN s USING (cluster_id), t),
wx AS (SELECT *, {p_sql('z')} AS pval FROM w),
o AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY pval, gene_id) AS rn, count(*) OVER (PARTITION BY cluster_id) AS m FROM wx),
de AS (SELECT *, least(1.0::DOUBLE, min(pval * m / rn) OVER (PARTITION BY cluster_id ORDER BY rn DESC)) AS padj FROM o)
"""


def de_of(v: Views):
    layer = v.counts.withColumn("value", F.log1p("value"))
    return c.benjamini_hochberg(ranktests.wilcoxon(layer, v.obs, "cluster_id"), "pval", ("cluster_id",), tie=("gene_id",))


@query("wilcoxon", _WILCOX + "SELECT cluster_id, gene_id, round(z, 5) AS score, round(pval, 5) AS pval, round(lfc, 5) AS lfc, round(pts, 6) AS pts, round(pts_rest, 6) AS pts_rest, round(padj, 5) AS padj FROM de")
def wilcoxon(v: Views):
    d = de_of(v)
    return d.select("cluster_id", "gene_id", *(F.round(x, 5).alias(x) for x in ("score", "pval", "lfc")), r6("pts", "pts"), r6("pts_rest", "pts_rest"), F.round("padj", 5).alias("padj"))


@query("wilcoxon_levels", f"""--with d AS (SELECT cell_id, cluster_id, condition, gene_id, coalesce(value, 0) AS value FROM (SELECT * FROM obs, (SELECT DISTINCT gene_id FROM counts) WHERE condition IN ('ASIA', 'EUROPE')) LEFT JOIN counts USING (cell_id, gene_id)),
r AS (SELECT *, rank() OVER (PARTITION BY cluster_id, gene_id ORDER BY value) + (count(*) OVER (PARTITION BY cluster_id, gene_id, value) - 1) / 2.0::DOUBLE AS rk FROM d),
g AS (SELECT cluster_id, gene_id, sum(rk) FILTER (condition = 'ASIA') AS rs, count(*) FILTER (condition = 'ASIA')::DOUBLE AS n1, count(*) FILTER (condition = 'EUROPE')::DOUBLE AS n2, count(*) FILTER (value > 0 AND condition = 'ASIA') AS ka, count(*) FILTER (value > 0 AND condition = 'EUROPE') AS kb FROM r GROUP BY 1, 2),
w AS (SELECT *, (rs - n1 * (n1 + n2 + 1) / 2) / sqrt(n1 * n2 * (n1 + n2 + 1) / 12) AS z FROM g WHERE ka + kb > 0)
SELECT cluster_id, gene_id, round(z, 5) AS score, round({p_sql('z')}, 5) AS pval, round(ka / n1, 6) AS pct_a, round(kb / n2, 6) AS pct_b FROM w""")
def wilcoxon_levels(v: Views):
    d = ranktests.wilcoxon_levels(v.counts, v.obs, "cluster_id", "condition", "ASIA", "EUROPE")
    return d.select("cluster_id", "gene_id", F.round("score", 5).alias("score"), F.round("pval", 5).alias("pval"), r6("pct_a", "pct_a"), r6("pct_b", "pct_b"))


@query("t_test", """--with s AS (SELECT cluster_id AS c, count(*)::DOUBLE AS n1 FROM obs GROUP BY 1), t AS (SELECT count(*)::DOUBLE AS n FROM obs),
d AS (SELECT cluster_id, gene_id, coalesce(value, 0)::DOUBLE AS value FROM (SELECT * FROM obs, (SELECT DISTINCT gene_id FROM counts)) LEFT JOIN counts USING (cell_id, gene_id)),
g AS (SELECT c AS cluster_id, gene_id, avg(value) FILTER (cluster_id = c) AS m1, avg(value) FILTER (cluster_id != c) AS m2, var_samp(value) FILTER (cluster_id = c) / min(n1) AS v1, var_samp(value) FILTER (cluster_id != c) / (min(n) - min(n1)) AS v2, min(n1) AS n1, min(n) - min(n1) AS n2 FROM d, s, t GROUP BY 1, 2)
SELECT cluster_id, gene_id, round((m1 - m2) / sqrt(v1 + v2), 5) AS t, round((v1 + v2) * (v1 + v2) / (v1 * v1 / (n1 - 1) + v2 * v2 / (n2 - 1)), 4) AS df FROM g""")
def t_test(v: Views):
    return ranktests.t_test(v.counts, v.obs, "cluster_id").select("cluster_id", "gene_id", F.round("t", 5).alias("t"), F.round("df", 4).alias("df"))


@query("top_genes", _WILCOX + ", k AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY padj, abs(lfc) DESC, gene_id) AS rank FROM (SELECT cluster_id, gene_id, round(padj, 7) AS padj, round(lfc, 7) AS lfc FROM de) WHERE padj < 0.9) SELECT cluster_id, gene_id, rank FROM k WHERE rank <= 5")
def top_genes(v: Views):
    d = de_of(v).select("cluster_id", "gene_id", F.round("padj", 7).alias("padj"), F.round("lfc", 7).alias("lfc"))
    return ranking.top_genes(d, ["cluster_id"], 5, 0.9).select("cluster_id", "gene_id", "rank")


@query("top_signed", _WILCOX + ", k AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY padj < 0.5 DESC, padj, abs(lfc) DESC, gene_id) AS rank FROM (SELECT cluster_id, gene_id, round(padj, 7) AS padj, round(lfc, 7) AS lfc FROM de) WHERE lfc > 0) SELECT cluster_id, gene_id, padj < 0.5 AS significant, rank FROM k WHERE rank <= 6")
def top_signed(v: Views):
    d = de_of(v).select("cluster_id", "gene_id", F.round("padj", 7).alias("padj"), F.round("lfc", 7).alias("lfc"))
    return ranking.top_signed(d, ["cluster_id"], 6, 1, 0.5).select("cluster_id", "gene_id", "significant", "rank")


@query("top_enrichment", _WILCOX + ", k AS (SELECT *, CASE WHEN z > 0 THEN 'up' ELSE 'down' END AS side FROM (SELECT cluster_id, gene_id, round(padj, 7) AS padj, round(z, 7) AS z FROM de) WHERE z != 0), n AS (SELECT *, row_number() OVER (PARTITION BY cluster_id, side ORDER BY padj, abs(z) DESC, gene_id) AS rank FROM k) SELECT cluster_id, side, gene_id AS pathway, rank FROM n WHERE rank <= 3")
def top_enrichment(v: Views):
    d = de_of(v).select("cluster_id", F.col("gene_id").alias("pathway"), F.round("padj", 7).alias("padj"), F.round("score", 7).alias("score"))
    return ranking.top_enrichment(d, ["cluster_id"], 3).select("cluster_id", "side", "pathway", "rank")


_TIERS = _WILCOX + """, x AS (SELECT cluster_id, gene_id, lfc AS wilcoxon_lfc, padj AS wilcoxon_padj, z / 2 AS logreg_coef, lfc * 3 AS pb_lfc, pts >= 0.5 AS ok FROM de),
h AS (SELECT *, (wilcoxon_padj < 0.7 AND abs(wilcoxon_lfc) >= 0.02 AND ok)::BIGINT + (abs(logreg_coef) >= 0.5)::BIGINT + (abs(pb_lfc) >= 0.1)::BIGINT AS hits FROM x),
q AS (SELECT *, CASE WHEN hits = 3 AND sign(wilcoxon_lfc) = sign(pb_lfc) AND sign(wilcoxon_lfc) = sign(logreg_coef) THEN 'Tier1' WHEN hits >= 2 THEN 'Tier2' WHEN hits >= 1 THEN 'Tier3' END AS tier FROM h)
"""


@query("consensus_tiers", _TIERS + "SELECT cluster_id, gene_id, hits, tier, hits + CASE tier WHEN 'Tier1' THEN 2 WHEN 'Tier2' THEN 1 ELSE 0 END AS score FROM q")
def consensus_tiers(v: Views):
    rows = de_of(v).select("cluster_id", "gene_id", F.col("lfc").alias("wilcoxon_lfc"), F.col("padj").alias("wilcoxon_padj"), (F.col("score") / 2).alias("logreg_coef"), (F.col("lfc") * 3).alias("pb_lfc"), (F.col("pts") >= 0.5).alias("ok"))
    return ranktests.consensus_tiers(rows, alpha=0.7, lfc=0.02, coef=0.5, pb=0.1).select("cluster_id", "gene_id", "hits", "tier", "score")


_PV = "--with p AS (SELECT p_partkey AS id, p_brand AS family, ((p_partkey * 7919) % 10007 + 1) / 10008.0::DOUBLE AS pval, (1 + p_size)::DOUBLE AS w FROM part)"


def pvalues(v: Views):
    return v.table("part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("family"), (((F.col("p_partkey") * 7919) % 10007 + 1) / F.lit(10008.0)).alias("pval"), (F.lit(1.0) + F.col("p_size")).alias("w"))


@query("bh_adjust", _PV + ", r AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY pval, id) AS k, count(*) OVER (PARTITION BY family) AS m FROM p) SELECT id, round(least(1.0::DOUBLE, min(pval * m / k) OVER (PARTITION BY family ORDER BY k DESC)), 9) AS padj FROM r")
def bh_adjust(v: Views):
    return c.benjamini_hochberg(pvalues(v), "pval", ("family",), tie=("id",)).select("id", F.round("padj", 9).alias("padj"))


@query("bh_weighted", _PV + ", q AS (SELECT id, family, least(1.0::DOUBLE, pval / (w / avg(w) OVER (PARTITION BY family))) AS p FROM p), r AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY p, id) AS k, count(*) OVER (PARTITION BY family) AS m FROM q) SELECT id, round(least(1.0::DOUBLE, min(p * m / k) OVER (PARTITION BY family ORDER BY k DESC)), 9) AS padj FROM r")
def bh_weighted(v: Views):
    return c.weighted_benjamini_hochberg(pvalues(v), "pval", "w", ("family",), tie=("id",)).select("id", F.round("padj", 9).alias("padj"))


_MEANS = "--with m AS (SELECT cluster_id, gene_id, sum(value) / n AS mean FROM counts JOIN obs USING (cell_id) JOIN (SELECT cluster_id, count(*) AS n FROM obs GROUP BY 1) USING (cluster_id) GROUP BY 1, 2, n), z AS (SELECT *, CASE WHEN stddev_samp(mean) OVER w > 0 THEN (mean - avg(mean) OVER w) / (stddev_samp(mean) OVER w + 1e-9) ELSE 0 END AS z FROM m WINDOW w AS (PARTITION BY gene_id))"


def means_of(v: Views):
    return pseudobulk.means(v.counts, v.obs, "cluster_id")


@query("column_zscore", _MEANS + " SELECT cluster_id, gene_id, round(z, 6) AS z FROM z")
def column_zscore(v: Views):
    return means_of(v).select("cluster_id", "gene_id", F.round(c.z_sample(F.col("mean"), Window.partitionBy("gene_id")), 6).alias("z"))


@query("min_max", _MEANS + " SELECT cluster_id, gene_id, round(CASE WHEN max(mean) OVER w > min(mean) OVER w THEN (mean - min(mean) OVER w) / (max(mean) OVER w - min(mean) OVER w) ELSE 0 END, 6) AS scaled FROM m WINDOW w AS (PARTITION BY gene_id)")
def min_max(v: Views):
    return means_of(v).select("cluster_id", "gene_id", F.round(c.min_max(F.col("mean"), Window.partitionBy("gene_id")), 6).alias("scaled"))


@query("top_variance", _MEANS + ", s AS (SELECT gene_id, round(var_samp(mean), 9) AS score FROM m GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY score DESC, gene_id) AS rank FROM s) SELECT gene_id, round(score, 6) AS score, rank FROM r WHERE rank <= 10")
def top_variance(v: Views):
    return ranking.top_features(means_of(v), "gene_id", "mean", 10).withColumn("score", F.round("score", 6))


@query("balanced_top", _MEANS + ", s AS (SELECT gene_id, round(avg(z * (1 + length(cluster_id))), 9) AS mean FROM z GROUP BY 1), a AS (SELECT *, row_number() OVER (ORDER BY mean DESC, gene_id) AS u, row_number() OVER (ORDER BY mean, gene_id) AS d FROM s) SELECT gene_id, round(mean, 6) AS mean FROM a WHERE (mean > 0 AND u <= 4) OR (mean < 0 AND d <= 5)")
def balanced_top(v: Views):
    rows = means_of(v).select("cluster_id", "gene_id", (c.z_sample(F.col("mean"), Window.partitionBy("gene_id")) * (1 + F.length("cluster_id"))).alias("z"))
    return ranking.balanced_top(rows, "gene_id", "z", 9).withColumn("mean", F.round("mean", 6))


@query("stratified_sample", "SELECT cell_id, cluster_id FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY md5('7|' || cell_id), cell_id) AS k FROM obs) WHERE k <= 50")
def stratified_sample(v: Views):
    return ranking.stratified(v.obs, "cluster_id", 50, "7").select("cell_id", "cluster_id")


_CURVE = "--with c AS (SELECT p_size AS x, 0.5::DOUBLE + ((p_size * 37) % 50) / 100.0::DOUBLE AS stability, (3 + (p_size * 13) % 11)::BIGINT AS k FROM part GROUP BY 1)"


def curve_of(v: Views):
    x = F.col("p_size")
    return v.table("part").select("p_size").distinct().select(x.alias("x"), (F.lit(0.5) + ((x * 37) % 50) / F.lit(100.0)).alias("stability"), (3 + (x * 13) % 11).cast("long").alias("k"))


@query("parsimonious_pick", _CURVE + " SELECT min(x) AS x FROM c WHERE stability >= 0.97 * (SELECT max(stability) FROM c)")
def parsimonious_pick(v: Views):
    return ranking.parsimonious(curve_of(v), "x", "stability", 0.97)


@query("stability_knee", _CURVE + " SELECT min(x) AS x FROM c WHERE stability >= 0.95 * (SELECT max(stability) FROM c)")
def stability_knee(v: Views):
    return ranking.parsimonious(curve_of(v), "x", "stability", 0.95)


@query("plateaus", _CURVE + ", f AS (SELECT *, sum(CASE WHEN stability >= 0.6 THEN 0 ELSE 1 END) OVER (ORDER BY x) AS i FROM c) SELECT min(x) AS start, max(x) AS end, count(*) AS length, round(avg(stability), 6) AS mean FROM f WHERE stability >= 0.6 GROUP BY i HAVING count(*) >= 3")
def plateaus(v: Views):
    return ranking.plateaus(curve_of(v), "x", F.col("stability") >= 0.6).withColumn("mean", F.round("mean", 6))


@query("cluster_jump", _CURVE + " SELECT x, round(abs(k - lag(k) OVER (ORDER BY x)) / greatest(lag(k) OVER (ORDER BY x), 10)::DOUBLE, 6) AS jump FROM c")
def cluster_jump(v: Views):
    return selection.jumps(curve_of(v), "x", "k").select("x", F.round("jump", 6).alias("jump"))


@query("smoothed_stability", _CURVE + " SELECT x, round((stability + coalesce(lag(stability) OVER (ORDER BY x), 0)) / CASE WHEN lag(stability) OVER (ORDER BY x) IS NULL THEN 1 ELSE 2 END, 6) AS smoothed FROM c")
def smoothed_stability(v: Views):
    return selection.smoothed(curve_of(v), "x", "stability").select("x", F.round("smoothed", 6).alias("smoothed"))


@query("composite_selection", _CURVE + ", n AS (SELECT x, (stability - min(stability) OVER ()) / (max(stability) OVER () - min(stability) OVER ()) AS a, (k - min(k) OVER ()) / (max(k) OVER () - min(k) OVER ())::DOUBLE AS b FROM c) SELECT x, round(0.5::DOUBLE * a + 0.35::DOUBLE * b, 6) AS score FROM n")
def composite_selection(v: Views):
    return ranking.selection_scores(curve_of(v), {"stability": 0.5, "k": 0.35}, "x").select("x", F.round("score", 6).alias("score"))


@query("pc_count", "--with s AS (SELECT p_size AS component, count(*)::DOUBLE / (SELECT count(*) FROM part) AS share FROM part GROUP BY 1), c AS (SELECT component, sum(share) OVER (ORDER BY component) AS cum FROM s) SELECT greatest(20, least(50, coalesce(min(component) FILTER (cum >= 0.85), max(component))))::BIGINT AS n_components FROM c")
def pc_count(v: Views):
    part = v.table("part")
    total = part.agg(F.count("*").alias("n"))
    rows = part.groupBy(F.col("p_size").alias("component")).count().crossJoin(F.broadcast(total)).select("component", (F.col("count") / F.col("n")).alias("share"))
    return ranking.explained_components(rows)


@query("best_embedding", "--with m AS (SELECT r_name AS name, (r_regionkey * 7 % 5) / 5.0::DOUBLE AS bio, (r_regionkey * 3 % 5) / 5.0::DOUBLE AS batch FROM region), t AS (SELECT *, 0.6::DOUBLE * bio + 0.4::DOUBLE * batch AS total FROM m), b AS (SELECT bio AS b1, batch AS b2 FROM m WHERE name = 'ASIA'), x AS (SELECT name, CASE WHEN bio > b1 AND batch > b2 THEN 0 WHEN bio > b1 THEN 1 WHEN batch > b2 THEN 2 ELSE 3 END AS tier, total FROM t, b) SELECT name, tier::INTEGER AS tier, round(total, 6) AS total FROM x ORDER BY tier, total DESC, name LIMIT 1")
def best_embedding(v: Views):
    k = F.col("r_regionkey")
    rows = v.table("region").select(F.col("r_name").alias("name"), ((k * 7 % 5) / F.lit(5.0)).alias("bio"), ((k * 3 % 5) / F.lit(5.0)).alias("batch"))
    return ranking.best_embedding(rows.withColumn("total", 0.6 * F.col("bio") + 0.4 * F.col("batch")), "ASIA").withColumn("total", F.round("total", 6))


@query("adjusted_rand", "--with n AS (SELECT cluster_id, condition, count(*)::DOUBLE AS n FROM obs GROUP BY 1, 2), s AS (SELECT sum(n * (n - 1) / 2) AS ij, sum(n) AS t FROM n), a AS (SELECT sum(x * (x - 1) / 2) AS a FROM (SELECT sum(n) AS x FROM n GROUP BY cluster_id)), b AS (SELECT sum(x * (x - 1) / 2) AS b FROM (SELECT sum(n) AS x FROM n GROUP BY condition)) SELECT round((ij - a * b / (t * (t - 1) / 2)) / ((a + b) / 2 - a * b / (t * (t - 1) / 2)), 6) AS ari FROM s, a, b")
def adjusted_rand(v: Views):
    return selection.adjusted_rand(v.obs, "cluster_id", "condition").withColumn("ari", F.round("ari", 6))


_CENTRES = "--with x AS (SELECT label, unnest(vec) AS value, generate_subscripts(vec, 1) AS dim FROM emb), c AS (SELECT label, dim, avg(value::DOUBLE) AS value FROM x GROUP BY 1, 2), d AS (SELECT a.label, b.label AS other, sqrt(sum((a.value - b.value) * (a.value - b.value))) AS distance FROM c a JOIN c b ON a.dim = b.dim AND a.label != b.label GROUP BY 1, 2)"


@query("centroid_distance", _CENTRES + " SELECT label, other, round(distance, 6) AS distance FROM d")
def centroid_distance(v: Views):
    return selection.centroid_distances(selection.centroids(v.emb, "label"), "label").withColumn("distance", F.round("distance", 6))


@query("centroid_silhouette", _CENTRES + ", s AS (SELECT label, min(distance) AS a, avg(distance) AS b FROM d GROUP BY 1) SELECT label, round(a, 6) AS a, round(b, 6) AS b, round((b - a) / greatest(a, b), 6) AS silhouette FROM s")
def centroid_silhouette(v: Views):
    return selection.centroid_silhouette(v.emb, "label").select("label", r6("a", "a"), r6("b", "b"), r6("silhouette", "silhouette"))


@query("tiny_cluster_penalty", "--with n AS (SELECT label, count(*) AS n FROM emb GROUP BY 1) SELECT round(0.5 * ((1 - count(*) FILTER (n < 50)::DOUBLE / count(*)) + (1 - coalesce(sum(n) FILTER (n < 50), 0)::DOUBLE / sum(n))), 6) AS penalty FROM n")
def tiny_cluster_penalty(v: Views):
    return selection.tiny_clusters(v.emb, "label", 50).withColumn("penalty", F.round("penalty", 6))


@query("homogeneity", "--with n AS (SELECT cluster_id, condition, count(*) AS n FROM obs GROUP BY 1, 2), p AS (SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY cluster_id) AS p FROM n), g AS (SELECT cluster_id, max(p) AS top, greatest(count(*) FILTER (p >= 0.2) - 1, 0) AS more FROM p GROUP BY 1) SELECT round(avg(top), 6) AS homogeneity, round(avg(more), 6) AS fragmentation FROM g")
def homogeneity(v: Views):
    return selection.homogeneity(v.obs, "cluster_id", "condition", 0.2).select(r6("homogeneity", "homogeneity"), r6("fragmentation", "fragmentation"))


@query("resolution_grid", "SELECT k, round(CASE WHEN k = 24 THEN 2.5 ELSE 0.1 + k * 0.1 END::DOUBLE, 9) AS resolution FROM (SELECT unnest(range(25)) AS k)")
def resolution_grid(v: Views):
    return selection.resolution_grid(v.spark).withColumn("resolution", F.round("resolution", 9))


_COS = _MEANS + ", k AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY round(abs(z), 9) DESC, gene_id) <= 8 AS t FROM z), c AS (SELECT a.cluster_id AS a, b.cluster_id AS b, sum(a.z * b.z) / nullif(sqrt(sum(a.z * a.z)) * sqrt(sum(b.z * b.z)), 0) AS cosine FROM k a JOIN k b ON a.gene_id = b.gene_id AND a.cluster_id < b.cluster_id AND (a.t OR b.t) GROUP BY 1, 2)"


def cosines(v: Views):
    return selection.cosine_pairs(means_of(v), "cluster_id", "gene_id", "mean", 8)


@query("compaction_cosine", _COS + " SELECT a, b, round(coalesce(cosine, 0), 6) AS cosine FROM c")
def compaction_cosine(v: Views):
    return cosines(v).withColumn("cosine", F.round("cosine", 6))


@query("compaction_pass", _COS + ", t AS (SELECT least(0.98, greatest(0.7, quantile_cont(cosine, 0.9)))::DOUBLE AS threshold FROM c) SELECT a, b, round(threshold, 6) AS threshold, cosine >= threshold AS passes FROM c, t")
def compaction_pass(v: Views):
    return selection.adaptive_pass(cosines(v)).select("a", "b", F.round("threshold", 6).alias("threshold"), "passes")


@query("compacted_clusters")
def compacted_clusters(v: Views):
    """Components of the pass edges; grouping of a few hundred clusters runs on the driver, so no SQL text."""
    edges = [(r["a"], r["b"]) for r in selection.adaptive_pass(cosines(v), floor=-0.5).where("passes").select("a", "b").collect()]
    sizes = {r["cluster_id"]: r["count"] for r in v.obs.groupBy("cluster_id").count().collect()}
    return v.spark.createDataFrame(sorted(selection.compact(edges, sizes).items()), "cluster_id string, code string")


_CLIFF = "--with r AS (SELECT cluster_id, condition AS side, total_counts AS value FROM cells WHERE condition IN ('ASIA', 'EUROPE')), k AS (SELECT a.cluster_id, avg(sign(a.value - b.value))::DOUBLE AS delta, sum(CASE WHEN a.value > b.value THEN 1.0 WHEN a.value = b.value THEN 0.5 ELSE 0 END)::DOUBLE AS u FROM r a JOIN r b ON a.cluster_id = b.cluster_id AND a.side = 'ASIA' AND b.side = 'EUROPE' GROUP BY 1), n AS (SELECT cluster_id, count(*) FILTER (side = 'ASIA') AS n_a, count(*) FILTER (side = 'EUROPE') AS n_b FROM r GROUP BY 1) SELECT cluster_id, n_a, n_b, round(delta, 6) AS delta, u FROM k JOIN n USING (cluster_id)"


@query("cliffs_delta", _CLIFF)
def cliffs_delta(v: Views):
    return ranktests.cliffs_delta(v.cells, ["cluster_id"], "condition", "total_counts", "ASIA", "EUROPE").withColumn("delta", F.round("delta", 6))


_CLR = "--with g AS (SELECT * FROM (SELECT DISTINCT sample_id FROM obs), (SELECT DISTINCT cluster_id FROM obs)), x AS (SELECT sample_id, cluster_id, count(cell_id) AS n FROM g LEFT JOIN obs USING (sample_id, cluster_id) GROUP BY 1, 2), shares AS (SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY sample_id) AS share FROM x), c AS (SELECT *, ln(share + 1e-6) - avg(ln(share + 1e-6)) OVER (PARTITION BY sample_id) AS clr FROM shares)"


@query("clr_transform", _CLR + " SELECT sample_id, cluster_id, round(clr, 6) AS clr FROM c")
def clr_transform(v: Views):
    return ranktests.clr(pseudobulk.crosstab(v.obs, "sample_id", "cluster_id"), "sample_id").select("sample_id", "cluster_id", F.round("clr", 6).alias("clr"))


_DA = "--with r AS (SELECT p_type AS cluster, p_brand AS term, CASE p_size % 3 WHEN 0 THEN 'graph' WHEN 1 THEN 'clr' ELSE 'sccoda' END AS method, avg(p_size - 25)::DOUBLE AS effect, ((min(p_partkey) * 31) % 100) / 500.0::DOUBLE AS fdr FROM part GROUP BY 1, 2, 3)"


@query("da_consensus", _DA + ", w AS (SELECT cluster, term, count(*) AS n_methods, count(*) FILTER (fdr < 0.05) AS n_sig, avg(effect) AS mean_effect, count(DISTINCT sign(effect)) = 1 AS sign_agree, max(fdr < 0.05) FILTER (method = 'graph') AS gs, max(sign(effect)) FILTER (method = 'graph') AS g, max(sign(effect)) FILTER (method = 'clr') AS c, max(sign(effect)) FILTER (method = 'sccoda') AS s FROM r GROUP BY 1, 2) SELECT cluster, term, n_methods, n_sig, round(mean_effect, 6) AS mean_effect, sign_agree, coalesce(gs AND (coalesce(c = g, false) OR coalesce(s = g, false)), false) AS high_confidence FROM w")
def da_consensus(v: Views):
    rows = v.table("part").withColumn("method", F.when(F.col("p_size") % 3 == 0, "graph").when(F.col("p_size") % 3 == 1, "clr").otherwise("sccoda")).groupBy(F.col("p_type").alias("cluster"), F.col("p_brand").alias("term"), "method").agg(F.avg((F.col("p_size") - 25).cast("double")).alias("effect"), (((F.min("p_partkey") * 31) % 100) / F.lit(500.0)).alias("fdr"))
    return ranktests.da_consensus(rows).withColumn("mean_effect", F.round("mean_effect", 6))


@query("effect_shrinkage", _DA + " SELECT cluster, term, method, round(effect * 10 / (10 + 5.0::DOUBLE), 6) AS shrunk FROM r")
def effect_shrinkage(v: Views):
    rows = v.table("part").withColumn("method", F.when(F.col("p_size") % 3 == 0, "graph").when(F.col("p_size") % 3 == 1, "clr").otherwise("sccoda")).groupBy(F.col("p_type").alias("cluster"), F.col("p_brand").alias("term"), "method").agg(F.avg((F.col("p_size") - 25).cast("double")).alias("effect"))
    return rows.select("cluster", "term", "method", F.round(ranktests.shrink(F.col("effect"), F.lit(10), 5.0), 6).alias("shrunk"))
