"""Enrichment, modules and ligand-receptor scoring over the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import communication, enrichment, pseudobulk
from .registry import query
from .views import Views, r6

_NET = "--with net0 AS (SELECT p_type AS source, p_brand AS target, avg(CASE WHEN p_size % 2 = 0 THEN 1.0 ELSE -1.0 END)::DOUBLE AS weight FROM part WHERE p_size <= 6 GROUP BY 1, 2), big AS (SELECT source FROM net0 GROUP BY 1 HAVING count(*) >= 3), net AS (SELECT * FROM net0 WHERE source IN (FROM big)), m AS (SELECT cluster_id, gene_id, sum(value) / n AS value FROM counts JOIN obs USING (cell_id) JOIN (SELECT cluster_id, count(*) AS n FROM obs GROUP BY 1) USING (cluster_id) GROUP BY 1, 2, n)"


def net_of(v: Views):
    edges = v.table("part").where("p_size <= 6").select(F.col("p_type").alias("source"), F.col("p_brand").alias("target"), F.when(F.col("p_size") % 2 == 0, 1.0).otherwise(-1.0).alias("weight"))
    return enrichment.prepare(edges, v.var, 3)


def matrix_of(v: Views):
    return pseudobulk.means(v.counts, v.obs, "cluster_id").select("cluster_id", "gene_id", F.col("mean").alias("value"))


@query("network_prepare", _NET + " SELECT source, target, round(weight, 6) AS weight FROM net")
def network_prepare(v: Views):
    return net_of(v).select("source", "target", r6("weight", "weight"))


@query("activity_wsum", _NET + " SELECT cluster_id, source, round(sum(weight * value), 6) AS score FROM m JOIN net ON gene_id = target GROUP BY 1, 2")
def activity_wsum(v: Views):
    return enrichment.weighted_sum(matrix_of(v), net_of(v), "cluster_id").withColumn("score", F.round("score", 6))


_ULM = _NET + ", g AS (SELECT cluster_id, source, value, coalesce(weight, 0) AS weight FROM (SELECT m.*, source FROM m, (SELECT DISTINCT source FROM net)) LEFT JOIN net USING (source) WHERE target = gene_id), d AS (SELECT x.cluster_id, x.source, x.value, coalesce(net.weight, 0) AS weight FROM (SELECT m.*, s.source FROM m, (SELECT DISTINCT source FROM net) s) x LEFT JOIN net ON net.source = x.source AND net.target = x.gene_id), u AS (SELECT cluster_id, source, corr(value, weight) AS r, count(*) AS n FROM d GROUP BY 1, 2)"


@query("activity_ulm", _ULM + " SELECT cluster_id, source, round(r * sqrt((n - 2) / ((1 - r) * (1 + r))), 5) AS score FROM u")
def activity_ulm(v: Views):
    return enrichment.univariate(matrix_of(v), net_of(v), "cluster_id").withColumn("score", F.round("score", 5))


_AUC = _NET + ", r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY value DESC, gene_id) AS rk FROM m), k AS (SELECT source, least(count(*), 10) AS k FROM net GROUP BY 1), a AS (SELECT cluster_id, source, sum(10 - rk + 1) AS area FROM r JOIN net ON gene_id = target WHERE rk <= 10 GROUP BY 1, 2)"


@query("activity_aucell", _AUC + " SELECT cluster_id, source, round(area / (k * 10 - k * (k - 1) / 2), 6) AS score FROM a JOIN k USING (source)")
def activity_aucell(v: Views):
    return enrichment.aucell(matrix_of(v), net_of(v), "cluster_id", 10).withColumn("score", F.round("score", 6))


@query("activity_consensus", _AUC + ", b AS (SELECT cluster_id, source, area / (k * 10 - k * (k - 1) / 2) AS s FROM a JOIN k USING (source)), w AS (SELECT cluster_id, source, sum(weight * value) AS s FROM m JOIN net ON gene_id = target GROUP BY 1, 2) SELECT cluster_id, source, round((b.s + w.s) / 2, 6) AS score FROM b JOIN w USING (cluster_id, source)")
def activity_consensus(v: Views):
    a = enrichment.aucell(matrix_of(v), net_of(v), "cluster_id", 10).withColumn("method", F.lit("aucell"))
    b = enrichment.weighted_sum(matrix_of(v), net_of(v), "cluster_id").withColumn("method", F.lit("wsum"))
    return enrichment.consensus(a.unionByName(b), "cluster_id", 2).withColumn("score", F.round("score", 6))


@query("term_family", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN split_part(p_type, '_', 1) ELSE 'SET' END AS family FROM part")
def term_family(v: Views):
    term = F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).otherwise(F.concat(F.lit("SET::"), F.col("p_type")))
    return v.table("part").select("p_partkey", enrichment.family(term).alias("family"))


_ES = _NET + ", st AS (SELECT cluster_id, gene_id, value - avg(value) OVER (PARTITION BY cluster_id) AS stat FROM m), r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY stat DESC, gene_id) AS rk, count(*) OVER (PARTITION BY cluster_id) AS n FROM st), g AS (SELECT r.*, s.source, e.target IS NOT NULL AS hit FROM r CROSS JOIN (SELECT DISTINCT source FROM net) s LEFT JOIN net e ON e.source = s.source AND e.target = r.gene_id), t AS (SELECT cluster_id, source, sum(abs(stat)) FILTER (hit) AS w, count(*) FILTER (hit) AS k FROM g GROUP BY 1, 2), c AS (SELECT g.cluster_id, g.source, k, sum(CASE WHEN hit THEN abs(stat) / w ELSE -1.0 / (n - k) END) OVER (PARTITION BY g.cluster_id, g.source ORDER BY rk) AS run FROM g JOIN t USING (cluster_id, source) JOIN (SELECT cluster_id, count(*) AS all_n FROM st GROUP BY 1) USING (cluster_id) WHERE k < all_n AND w > 0), b AS (SELECT cluster_id, source, min(k) AS size, max(run) AS hi, least(min(run), 0) AS lo FROM c GROUP BY 1, 2)"


@query("running_sum_es", _ES + " SELECT cluster_id, source, size, round(CASE WHEN hi >= -lo THEN hi ELSE lo END, 6) AS es FROM b WHERE size >= 3")
def running_sum_es(v: Views):
    from pyspark.sql import Window

    stats = matrix_of(v).select("cluster_id", "gene_id", (F.col("value") - F.avg("value").over(Window.partitionBy("cluster_id"))).alias("stat"))
    return enrichment.running_sum(stats, net_of(v), "cluster_id", 3, 500).withColumn("es", F.round("es", 6))


@query("leading_edge", "SELECT r_name, array_to_string(list_sort(list(n_name))[1:2], ', ') AS preview, count(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1")
def leading_edge(v: Views):
    nation, region = v.table("nation"), v.table("region")
    edge = nation.join(region, nation.n_regionkey == region.r_regionkey).groupBy("r_name").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ";").alias("edge"))
    return edge.select("r_name", enrichment.leading_preview(F.col("edge"), 2).alias("x")).select("r_name", "x.preview", "x.n")


_JOINT = "--with act AS (SELECT p_type AS cluster, p_brand AS pathway, avg(p_size - 25.0)::DOUBLE AS score FROM part GROUP BY 1, 2), gs AS (SELECT p_type AS cluster, p_brand AS pathway, avg(p_retailprice - 1400)::DOUBLE / 100 AS nes, ((min(p_partkey) * 17) % 100) / 400.0::DOUBLE AS padj FROM part WHERE p_size > 4 GROUP BY 1, 2), j AS (SELECT *, sign(score) = sign(nes) AS c FROM act JOIN gs USING (cluster, pathway))"


@query("joint_enrichment", _JOINT + " SELECT cluster, pathway, c AS sign_concordant, c AND padj < 0.05 AS supported_by_both, (1000000 * (c AND padj < 0.05)::BIGINT + 100000 * c::BIGINT + 10000 * (padj < 0.05)::BIGINT + 10000 - dense_rank() OVER (ORDER BY round(abs(score), 9) DESC) + 10000 - dense_rank() OVER (ORDER BY round(abs(nes), 9) DESC))::BIGINT AS joint_rank FROM j")
def joint_enrichment(v: Views):
    part = v.table("part")
    act = part.groupBy(F.col("p_type").alias("cluster"), F.col("p_brand").alias("pathway")).agg(F.avg(F.col("p_size") - 25.0).alias("score"))
    gs = part.where("p_size > 4").groupBy(F.col("p_type").alias("cluster"), F.col("p_brand").alias("pathway")).agg((F.avg(F.col("p_retailprice") - 1400) / 100).alias("nes"), (((F.min("p_partkey") * 17) % 100) / F.lit(400.0)).alias("padj"))
    return enrichment.joint(act, gs).select("cluster", "pathway", "sign_concordant", "supported_by_both", "joint_rank")


@query("module_score", """--with mu AS (SELECT gene_id, sum(value) / (SELECT count(*) FROM obs) AS m FROM counts GROUP BY 1), b AS (SELECT *, ntile(5) OVER (ORDER BY m, gene_id) AS bin, gene_id IN ('Brand#11', 'Brand#12', 'Brand#21') AS mine FROM mu),
d AS (SELECT gene_id FROM (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY md5('0|' || gene_id), gene_id) AS r FROM b WHERE NOT mine AND bin IN (SELECT bin FROM b WHERE mine)) WHERE r <= 4),
s AS (SELECT cell_id, sum(value) FILTER (gene_id IN (SELECT gene_id FROM b WHERE mine)) AS x, sum(value) FILTER (gene_id IN (FROM d)) AS y FROM counts GROUP BY 1)
SELECT cell_id, round(coalesce(x, 0) / (SELECT count(*) FROM b WHERE mine) - coalesce(y, 0) / (SELECT count(*) FROM d), 6) AS score FROM obs LEFT JOIN s USING (cell_id)""")
def module_score(v: Views):
    return enrichment.module_score(v.counts, v.obs, ["Brand#11", "Brand#12", "Brand#21"]).withColumn("score", F.round("score", 6))


_LR = "--with m AS (SELECT cluster_id, gene_id, sum(value) / n AS mean, count(*)::DOUBLE / n AS fraction FROM counts JOIN obs USING (cell_id) JOIN (SELECT cluster_id, count(*) AS n FROM obs GROUP BY 1) USING (cluster_id) GROUP BY 1, 2, n), w AS (SELECT *, mean / sum(mean) OVER (PARTITION BY gene_id) AS weight FROM m), lr AS (SELECT unnest(['Brand#11', 'Brand#12', 'Brand#23']) AS ligand, unnest(['Brand#21', 'Brand#22', 'Brand#14']) AS receptor), mu AS (SELECT sum(value) / ((SELECT count(*) FROM obs) * count(DISTINCT gene_id)) AS mu FROM counts), ev AS (SELECT a.cluster_id AS source, b.cluster_id AS target, ligand, receptor, (a.mean + b.mean) / 2 AS lr_means, a.mean * b.mean AS expr_prod, a.weight * b.weight AS spec_weight, sqrt(a.mean * b.mean) / (sqrt(a.mean * b.mean) + mu) AS lrscore FROM lr JOIN w a ON a.gene_id = ligand AND a.fraction >= 0.1 JOIN w b ON b.gene_id = receptor AND b.fraction >= 0.1, mu)"


def pairs_of(v: Views):
    return v.spark.createDataFrame([("Brand#11", "Brand#21"), ("Brand#12", "Brand#22"), ("Brand#23", "Brand#14")], "ligand string, receptor string")


def events_of(v: Views):
    return communication.pair_scores(v.counts, v.obs, "cluster_id", pairs_of(v))


@query("ligand_receptor", _LR + " SELECT source, target, ligand, receptor, round(lr_means, 6) AS lr_means, round(expr_prod, 5) AS expr_prod, round(spec_weight, 6) AS spec_weight, round(lrscore, 6) AS lrscore FROM ev")
def ligand_receptor(v: Views):
    return events_of(v).select("source", "target", "ligand", "receptor", r6("lr_means", "lr_means"), F.round("expr_prod", 5).alias("expr_prod"), r6("spec_weight", "spec_weight"), r6("lrscore", "lrscore"))


@query("rank_aggregate", _LR + " SELECT source, target, ligand, receptor, round((rank() OVER (ORDER BY round(lr_means, 9) DESC)::DOUBLE / count(*) OVER () + rank() OVER (ORDER BY round(lrscore, 9) DESC)::DOUBLE / count(*) OVER ()) / 2, 6) AS magnitude_rank FROM ev")
def rank_aggregate(v: Views):
    return communication.aggregate_ranks(events_of(v), [("lr_means", False), ("lrscore", False)], ["source", "target", "ligand", "receptor"]).withColumn("magnitude_rank", F.round("magnitude_rank", 6))


@query("robust_rank_aggregate")
def robust_rank_aggregate(v: Views):
    """Seeded permutations."""
    scores = communication.specificities(events_of(v), v.counts, v.obs, "cluster_id", pairs_of(v))
    scores = communication.permuted_pvals(scores, v.counts, v.obs, "cluster_id", pairs_of(v))
    return scores.join(communication.robust_ranks(scores), communication.EVENT)


@query("source_target_summary", _LR + " SELECT source, target, count(*) AS n, round(avg(lrscore), 6) AS mean_score FROM ev GROUP BY 1, 2")
def source_target_summary(v: Views):
    return communication.summary(events_of(v), "lrscore").withColumn("mean_score", F.round("mean_score", 6))


@query("route_counts", _LR + ", r AS (SELECT source, CASE WHEN ligand = 'Brand#11' THEN 'looked up' ELSE 'Brand-Brand' END AS route FROM ev) SELECT source, route, count(*) AS n FROM r GROUP BY 1, 2")
def route_counts(v: Views):
    lookup = v.spark.createDataFrame([("brand 11", "brand 21", "looked up")], "ligand string, receptor string, pathway string")
    return communication.route(events_of(v), lookup).groupBy("source", "route").agg(F.count("*").alias("n"))


@query("cross_tissue_filter", _LR + " SELECT source, target, count(*) AS n FROM ev WHERE source IN ('BUILDING', 'MACHINERY') AND target IN ('FURNITURE') GROUP BY 1, 2")
def cross_tissue_filter(v: Views):
    levels = v.spark.createDataFrame([("BUILDING", "a"), ("MACHINERY", "a"), ("FURNITURE", "b")], "cluster string, level string")
    return communication.cross_filter(events_of(v), levels, "a", "b").groupBy("source", "target").agg(F.count("*").alias("n"))


@query("circos_edges", _LR + ", s AS (SELECT source, target, avg(lrscore) AS x FROM ev GROUP BY 1, 2), t AS (SELECT * FROM s ORDER BY round(x, 9) DESC, source, target LIMIT 4), l AS ((SELECT source AS n FROM t EXCEPT SELECT target FROM t) UNION ALL (SELECT target FROM t EXCEPT SELECT source FROM t)) SELECT source, target, round(x, 6) AS value FROM t UNION ALL SELECT n, n, 0 FROM l")
def circos_edges(v: Views):
    rows = events_of(v).groupBy("source", "target").agg(F.avg("lrscore").alias("x"))
    return communication.circos(rows, "x", 4).withColumn("value", F.round("value", 6))


_EV = """--with e AS (SELECT unnest([1, 2, 3])::BIGINT AS event, unnest(['BUILDING', 'MACHINERY', 'FURNITURE']) AS source, unnest(['FURNITURE', 'BUILDING', 'AUTOMOBILE']) AS target, unnest(['Brand#11', 'Brand#12_Brand#13', 'Brand#23']) AS ligand, unnest(['Brand#21_Brand#22', 'Brand#14', 'Brand#24']) AS receptor),
b AS (SELECT e.*, sample_id FROM e, (SELECT DISTINCT sample_id FROM obs)), nc AS (SELECT sample_id, cluster_id, count(*) AS n_cells FROM obs GROUP BY 1, 2),
per AS (SELECT sample_id, cluster_id, gene_id, sum(ln(1 + value)) AS s, count(*) AS k FROM counts JOIN obs USING (cell_id) GROUP BY 1, 2, 3),
l AS (SELECT event, sample_id, coalesce(max(n_cells), 0) AS c, sum(coalesce(s, 0)) / count(*) / max(n_cells) AS m, min(coalesce(k, 0))::DOUBLE / max(n_cells) AS p FROM (SELECT event, sample_id, source AS cluster_id, unnest(string_split(ligand, '_')) AS gene_id FROM b) LEFT JOIN per USING (sample_id, cluster_id, gene_id) LEFT JOIN nc USING (sample_id, cluster_id) GROUP BY 1, 2),
r AS (SELECT event, sample_id, coalesce(max(n_cells), 0) AS c, sum(coalesce(s, 0)) / count(*) / max(n_cells) AS m, min(coalesce(k, 0))::DOUBLE / max(n_cells) AS p FROM (SELECT event, sample_id, target AS cluster_id, unnest(string_split(receptor, '_')) AS gene_id FROM b) LEFT JOIN per USING (sample_id, cluster_id, gene_id) LEFT JOIN nc USING (sample_id, cluster_id) GROUP BY 1, 2),
sc AS (SELECT event, sample_id, CASE WHEN l.c < 9 THEN 'sender_cells' WHEN r.c < 9 THEN 'receiver_cells' WHEN l.p < 0.5 THEN 'ligand_detection' WHEN r.p < 0.5 THEN 'receptor_detection' END AS missing_reason, ln(1 + sqrt(l.m * r.m)) AS sco FROM l JOIN r USING (event, sample_id))
"""


def rescored(v: Views):
    events = v.spark.createDataFrame([(1, "BUILDING", "FURNITURE", "Brand#11", "Brand#21_Brand#22"), (2, "MACHINERY", "BUILDING", "Brand#12_Brand#13", "Brand#14"), (3, "FURNITURE", "AUTOMOBILE", "Brand#23", "Brand#24")], "event long, source string, target string, ligand string, receptor string")
    return communication.paired_rescore(v.counts, v.obs, events, "sample_id", "cluster_id", least_cells=9, least_share=0.5)


@query("paired_rescore", _EV + "SELECT event, sample_id, missing_reason, round(CASE WHEN missing_reason IS NULL THEN sco END, 6) AS score FROM sc")
def paired_rescore(v: Views):
    return rescored(v).select("event", "sample_id", "missing_reason", r6("score", "score"))


@query("paired_missingness", _EV + "SELECT event, count(*) AS n_total, count(*) FILTER (missing_reason IS NULL) AS n_scored, count(*) FILTER (missing_reason = 'sender_cells') AS n_sender_cells, count(*) FILTER (missing_reason = 'receiver_cells') AS n_receiver_cells, count(*) FILTER (missing_reason = 'ligand_detection') AS n_ligand_detection, count(*) FILTER (missing_reason = 'receptor_detection') AS n_receptor_detection FROM sc GROUP BY 1")
def paired_missingness(v: Views):
    return communication.missingness(rescored(v))


@query("paired_summary", _EV + "SELECT event, count(*) FILTER (missing_reason IS NULL) AS n_scored, round(avg(sco) FILTER (missing_reason IS NULL), 6) AS mean, round(median(sco) FILTER (missing_reason IS NULL), 6) AS median FROM sc GROUP BY 1")
def paired_summary(v: Views):
    return rescored(v).groupBy("event").agg(F.count("score").alias("n_scored"), F.round(F.avg("score"), 6).alias("mean"), F.round(F.median("score"), 6).alias("median"))


@query("ligand_activity", "--with t AS (SELECT cluster_id AS ligand, gene_id, sum(value) AS score FROM pb GROUP BY 1, 2) SELECT ligand, round(corr(score, (gene_id IN ('Brand#11', 'Brand#12', 'Brand#13'))::INTEGER), 6) AS activity FROM t GROUP BY 1")
def ligand_activity(v: Views):
    targets = v.pb.groupBy(F.col("cluster_id").alias("ligand"), "gene_id").agg(F.sum("value").alias("score"))
    return communication.ligand_activity(targets, v.var.where("gene_id in ('Brand#11', 'Brand#12', 'Brand#13')")).withColumn("activity", F.round("activity", 6))
