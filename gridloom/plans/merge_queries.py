"""Joins, merges, rounds, pseudobulk and summaries over the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import cluster_code, identifier, token
from ..operators import merge, pseudobulk, qc, rounds
from .registry import query
from .views import Views, r6


@query("sample_validation", """--with m AS (SELECT n_name AS sample_id FROM nation WHERE n_nationkey % 7 != 3 UNION ALL SELECT 'UNUSED')
SELECT (SELECT count(DISTINCT sample_id) FROM obs WHERE sample_id NOT IN (FROM m)) AS missing_metadata, (SELECT count(*) FROM m WHERE sample_id NOT IN (SELECT sample_id FROM obs)) AS unused_metadata, 0::BIGINT AS repeated_keys""")
def sample_validation(v: Views):
    side = v.table("nation").where("n_nationkey % 7 != 3").select(F.col("n_name").alias("sample_id")).unionByName(v.spark.createDataFrame([("UNUSED",)], "sample_id string"))
    return merge.key_report(v.obs, side, "sample_id")


@query("metadata_join", "SELECT cell_id, sample_id, r_name AS area, n_regionkey FROM obs JOIN nation ON sample_id = n_name JOIN region ON n_regionkey = r_regionkey")
def metadata_join(v: Views):
    nation, region = v.table("nation"), v.table("region")
    side = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_name", F.col("r_name").alias("area"), "n_regionkey")
    return merge.add_metadata(v.obs.select("cell_id", "sample_id"), side, "sample_id", "n_name", exact=False)


@query("gene_filter", "SELECT cell_id, count(*) AS n FROM counts JOIN var USING (gene_id) WHERE gene_type != 'x' AND gene_id NOT IN ('Brand#11', 'Brand#12') GROUP BY 1")
def gene_filter(v: Views):
    genes = v.var.where("gene_type != 'x' and gene_id not in ('Brand#11', 'Brand#12')")
    return v.counts.join(F.broadcast(genes), "gene_id", "left_semi").groupBy("cell_id").agg(F.count("*").alias("n"))


@query("gene_type_map", "SELECT gene_id, coalesce(CASE WHEN gene_id LIKE 'Brand#1%' THEN gene_type END, 'unknown') AS gene_type FROM var")
def gene_type_map(v: Views):
    known = v.var.where(F.col("gene_id").startswith("Brand#1"))
    return v.var.select("gene_id").join(F.broadcast(known), "gene_id", "left").withColumn("gene_type", F.coalesce("gene_type", F.lit("unknown")))


@query("barcode_restriction", "SELECT sample_id, sum(value) AS total FROM counts JOIN obs USING (cell_id) WHERE cell_id % 3 = 0 GROUP BY 1")
def barcode_restriction(v: Views):
    raw = v.counts.join(v.obs.select("cell_id", "sample_id"), "cell_id")
    return merge.restrict_to_barcodes(raw, v.obs.where("cell_id % 3 = 0").select("sample_id", "cell_id")).groupBy("sample_id").agg(F.sum("value").alias("total"))


@query("attach_raw_layer", "SELECT gene_id, sum(value) AS total FROM counts WHERE cell_id IN (SELECT cell_id FROM cells WHERE n_genes >= 10) AND gene_id < 'Brand#40' GROUP BY 1")
def attach_raw_layer(v: Views):
    return merge.attach_layer(v.cells.where("n_genes >= 10"), v.counts, v.var.where("gene_id < 'Brand#40'")).groupBy("gene_id").agg(F.sum("value").alias("total"))


_TWO = "--with m AS (SELECT 'a' AS dataset, 'a__' || cell_id AS cell_id, gene_id, value FROM counts WHERE cell_id % 2 = 0 AND gene_id < 'Brand#45' UNION ALL SELECT 'b', 'b__' || cell_id, gene_id, value FROM counts WHERE cell_id % 2 = 1 AND gene_id > 'Brand#14')\n"


def two(v: Views):
    return {"a": v.counts.where("cell_id % 2 = 0 and gene_id < 'Brand#45'"), "b": v.counts.where("cell_id % 2 = 1 and gene_id > 'Brand#14'")}


@query("merge_outer", _TWO + "SELECT dataset, count(DISTINCT cell_id) AS n_cells, count(DISTINCT gene_id) AS n_genes, sum(value) AS total FROM m GROUP BY 1")
def merge_outer(v: Views):
    return merge.merge_counts(two(v)).groupBy("dataset").agg(F.countDistinct("cell_id").alias("n_cells"), F.countDistinct("gene_id").alias("n_genes"), F.sum("value").alias("total"))


@query("merge_inner", _TWO + ", k AS (SELECT gene_id FROM m GROUP BY 1 HAVING count(DISTINCT dataset) = 2) SELECT dataset, gene_id, sum(value) AS total FROM m WHERE gene_id IN (FROM k) GROUP BY 1, 2")
def merge_inner(v: Views):
    return merge.merge_counts(two(v), "inner").groupBy("dataset", "gene_id").agg(F.sum("value").alias("total"))


@query("merge_var_fills", "SELECT gene_id, coalesce(CASE WHEN gene_id < 'Brand#45' THEN gene_type END, '') AS gene_type, coalesce(CASE WHEN gene_id > 'Brand#14' THEN true END, false) AS mito FROM var")
def merge_var_fills(v: Views):
    return merge.merge_var({"a": v.var.where("gene_id < 'Brand#45'"), "b": v.var.where("gene_id > 'Brand#14'").select("gene_id", F.lit(True).alias("mito"))}, {"gene_type": "", "mito": False})


_SIZE = "--with z AS (SELECT cluster_id, count(*) AS n_cells FROM obs GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n_cells DESC, cluster_id) - 1 AS cluster_rank FROM z), d AS (SELECT *, 'C' || lpad(cluster_rank::VARCHAR, 2, '0') AS code, 'C' || lpad(cluster_rank::VARCHAR, 2, '0') || ': ' || cluster_id AS display FROM r)\n"


@query("cluster_display", _SIZE + "SELECT cluster_id, n_cells, cluster_rank, code, display FROM d")
def cluster_display(v: Views):
    return rounds.display(v.obs)


def displayed(v: Views):
    return v.obs.join(F.broadcast(rounds.display(v.obs).select("cluster_id", "display")), "cluster_id")


@query("token_resolution", _SIZE + """, t AS (SELECT unnest(['0', 'C01', 'C02: ' || (SELECT cluster_id FROM d WHERE cluster_rank = 2), 'nothing']) AS token),
m AS (SELECT token, CASE WHEN token = cluster_rank::VARCHAR THEN 0 WHEN token = display THEN 1 WHEN token = code THEN 2 END AS way, cluster_rank FROM t LEFT JOIN d ON token = cluster_rank::VARCHAR OR token = display OR token = code)
SELECT token, min(way)::INTEGER AS way, min(cluster_rank) AS cluster, count(cluster_rank) AS n_matches FROM m GROUP BY 1""")
def token_resolution(v: Views):
    shown = rounds.display(v.obs).select(F.col("cluster_rank").alias("cluster"), F.col("display").alias("label"))
    tokens = shown.where("cluster = 2").select(F.col("label").alias("token")).unionByName(v.spark.createDataFrame([("0",), ("C01",), ("nothing",)], "token string"))
    return merge.resolve_tokens(tokens, shown)


@query("subset_by_clusters", _SIZE + "SELECT CASE WHEN code IN ('C00', 'C01') THEN 'large' ELSE 'small' END AS subset, count(*) AS n FROM obs JOIN d USING (cluster_id) WHERE code <= 'C03' GROUP BY 1")
def subset_by_clusters(v: Views):
    mapping = v.spark.createDataFrame([("C00", "large"), ("C01", "large"), ("C02", "small"), ("C03", "small")], "code string, subset string")
    return merge.subset_by_clusters(displayed(v), mapping, "display").groupBy("subset").agg(F.count("*").alias("n"))


@query("annotation_overlay", "SELECT cell_id, CASE WHEN cell_id % 10 = 1 THEN 'child one' WHEN cell_id % 10 = 2 THEN 'child two' ELSE cluster_id END AS label FROM obs")
def annotation_overlay(v: Views):
    parent = v.obs.select("cell_id", F.col("cluster_id").alias("label"))
    parts = [parent.where(f"cell_id % 10 = {k}").withColumn("label", F.lit(f"child {n}")) for k, n in ((1, "one"), (2, "two"))]
    return merge.overlay(parent, parts, "label")


@query("rename_collapse", _SIZE + ", n AS (SELECT CASE WHEN code IN ('C00', 'C03') THEN 'merged' ELSE cluster_id END AS label FROM obs JOIN d USING (cluster_id)), s AS (SELECT label, count(*) AS n_cells FROM n GROUP BY 1) SELECT label, n_cells, row_number() OVER (ORDER BY n_cells DESC, label) - 1 AS cluster_rank FROM s")
def rename_collapse(v: Views):
    mapping = v.spark.createDataFrame([("C00", "merged"), ("C03", "merged")], "code string, label string")
    return merge.relabel_by_size(merge.rename(displayed(v).withColumnRenamed("display", "label"), mapping, "label"), "label").select("label", "n_cells", "cluster_rank")


@query("round_rebuild", "--with p AS (SELECT CASE WHEN cell_id % 4 = 0 THEN 'Unknown' ELSE cluster_id END AS label FROM obs), s AS (SELECT label, count(*) AS n FROM p GROUP BY 1) SELECT label, n, 'C' || lpad((row_number() OVER (ORDER BY n DESC, label) - 1)::VARCHAR, 2, '0') AS code FROM s")
def round_rebuild(v: Views):
    parts = v.obs.where("cell_id % 4 != 0").select("cell_id", F.col("cluster_id").alias("label"))
    return rounds.rebuild(v.obs, parts).groupBy("label", "code").agg(F.count("*").alias("n"))


@query("round_lineage", "SELECT unnest(['r0_start', 'r1_child', 'r2_new']) AS round_id, unnest([NULL, 'r0_start', NULL]) AS parent_round_id, unnest([false, true, false]) AS active")
def round_lineage(v: Views):
    table = v.spark.createDataFrame([], "round_id string, parent_round_id string, round_type string, best_resolution double, active boolean")
    table = rounds.register(table, rounds.next_round_id(table, "start"), None, "base", 0.4)
    labels = v.obs.select(F.lit("r0_start").alias("round_id"), "cell_id", "cluster_id")
    table, labels = rounds.child(table, labels, "r0_start", rounds.next_round_id(table, "child"), "rename")
    table = rounds.register(table, rounds.next_round_id(table, "new"), None, "base", 0.8)
    return rounds.activate(table, "r1_child").select("round_id", "parent_round_id", "active")


@query("names_and_tokens", "SELECT n_name, regexp_extract('x C07: ' || n_name, 'C\\d+') AS code, replace(n_name, ':', '_') AS token, regexp_replace(trim(n_name), ' +', '_', 'g') AS name FROM nation")
def names_and_tokens(v: Views):
    n = F.col("n_name")
    return v.table("nation").select("n_name", cluster_code(F.concat(F.lit("x C07: "), n)).alias("code"), token(n).alias("token"), identifier(n).alias("name"))


@query("level_validity", "SELECT cluster_id, count(*) FILTER (condition = 'ASIA') AS n_a, count(*) FILTER (condition = 'EUROPE') AS n_b FROM obs GROUP BY 1 HAVING n_a >= 5 AND n_b >= 5")
def level_validity(v: Views):
    return merge.levels_present(v.obs, ["cluster_id"], "condition", ("ASIA", "EUROPE"), 5)


@query("contrast_pairs", "--with l AS (SELECT DISTINCT condition FROM obs) SELECT a.condition AS a, b.condition AS b FROM l a JOIN l b ON a.condition < b.condition")
def contrast_pairs(v: Views):
    from ..operators.conditions import all_pairs

    return all_pairs(v.obs, "condition")


@query("contrast_reference", "--with l AS (SELECT condition, count(*) AS n FROM obs GROUP BY 1), r AS (SELECT condition FROM l ORDER BY n DESC, condition LIMIT 1) SELECT l.condition AS a, r.condition AS b FROM l, r WHERE l.condition != r.condition")
def contrast_reference(v: Views):
    from ..operators.conditions import versus_reference

    return versus_reference(v.obs, "condition")


@query("condition_composite", "SELECT condition || '.' || cluster_id AS level, count(*) AS n FROM obs GROUP BY 1")
def condition_composite(v: Views):
    from ..operators.conditions import parse

    return v.obs.select(parse("condition:cluster_id").column().alias("level")).groupBy("level").agg(F.count("*").alias("n"))


@query("pseudobulk_sum", "SELECT sample_id, cluster_id, gene_id, value, n_cells, sample_id || '|' || cluster_id AS library FROM pb JOIN libs USING (sample_id, cluster_id) WHERE n_cells >= 3")
def pseudobulk_sum(v: Views):
    return pseudobulk.aggregate(v.counts, v.obs, "sample_id", "cluster_id", 3)


@query("pseudobulk_mean", "SELECT cluster_id, gene_id, round(sum(value) / n, 6) AS mean, round(count(*)::DOUBLE / n, 6) AS fraction FROM counts JOIN obs USING (cell_id) JOIN (SELECT cluster_id, count(*) AS n FROM obs GROUP BY 1) USING (cluster_id) GROUP BY 1, 2, n")
def pseudobulk_mean(v: Views):
    return pseudobulk.means(v.counts, v.obs, "cluster_id").select("cluster_id", "gene_id", r6("mean", "mean"), r6("fraction", "fraction"))


@query("pseudobulk_median", "--with g AS (SELECT cell_id, cluster_id, gene_id FROM obs, (SELECT DISTINCT gene_id FROM counts)) SELECT cluster_id, gene_id, median(coalesce(value, 0)::DOUBLE) AS median FROM g LEFT JOIN counts USING (cell_id, gene_id) GROUP BY 1, 2")
def pseudobulk_median(v: Views):
    return pseudobulk.medians(v.counts, v.obs, "cluster_id")


@query("pseudobulk_effect", """--with s AS (SELECT gene_id, sum(CASE WHEN condition = 'ASIA' THEN value ELSE 0 END) AS sum_a, sum(CASE WHEN condition = 'EUROPE' THEN value ELSE 0 END) AS sum_b FROM pb JOIN libs USING (sample_id, cluster_id) WHERE condition IN ('ASIA', 'EUROPE') GROUP BY 1)
SELECT gene_id, sum_a, sum_b, round(log2((sum_a + 1) / (sum_b + 1)), 6) AS log2fc, round(sum_a * 1e6 / sum(sum_a) OVER (), 4) AS cpm_a FROM s WHERE sum_a + sum_b >= 10""")
def pseudobulk_effect(v: Views):
    rows = v.pb.join(v.libs, ["sample_id", "cluster_id"])
    return pseudobulk.effect(rows, "condition", "ASIA", "EUROPE").select("gene_id", "sum_a", "sum_b", r6("log2fc", "log2fc"), F.round("cpm_a", 4).alias("cpm_a"))


@query("target_vs_rest", "--with s AS (SELECT sample_id, gene_id, sum(value) AS t, sum(CASE WHEN cluster_id = 'BUILDING' THEN value ELSE 0 END) AS x FROM pb GROUP BY 1, 2) SELECT sample_id, gene_id, 'target' AS side, x AS value FROM s UNION ALL SELECT sample_id, gene_id, 'rest', greatest(t - x, 0) FROM s")
def target_vs_rest(v: Views):
    return pseudobulk.target_vs_rest(v.pb, "sample_id", "cluster_id", "BUILDING")


_CROSS = "--with g AS (SELECT * FROM (SELECT DISTINCT sample_id FROM obs), (SELECT DISTINCT cluster_id FROM obs)), x AS (SELECT sample_id, cluster_id, count(cell_id) AS n FROM g LEFT JOIN obs USING (sample_id, cluster_id) GROUP BY 1, 2), shares AS (SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY sample_id) AS share FROM x)\n"


def table_of(v: Views):
    return pseudobulk.crosstab(v.obs, "sample_id", "cluster_id")


@query("crosstab", _CROSS + "SELECT sample_id, cluster_id, n, round(share, 6) AS share FROM shares")
def crosstab(v: Views):
    return table_of(v).withColumn("share", F.round("share", 6))


@query("stable_reference", _CROSS + ", m AS (SELECT cluster_id, median(share) AS m, avg(share) AS mean_share FROM shares GROUP BY 1), d AS (SELECT cluster_id, median(abs(share - m)) AS mad, min(mean_share) AS mean_share FROM shares JOIN m USING (cluster_id) GROUP BY 1) SELECT cluster_id AS reference, round(mad, 6) AS mad, round(mean_share, 6) AS mean_share FROM d WHERE mean_share >= 0.15 ORDER BY round(mad, 9), cluster_id LIMIT 1")
def stable_reference(v: Views):
    return pseudobulk.stable_reference(table_of(v), "cluster_id", 0.15).select("reference", r6("mad", "mad"), r6("mean_share", "mean_share"))


@query("composition_means", _CROSS + "SELECT condition, cluster_id, round(avg(share), 6) AS mean_share FROM shares JOIN (SELECT DISTINCT sample_id, condition FROM obs) USING (sample_id) GROUP BY 1, 2")
def composition_means(v: Views):
    return table_of(v).join(F.broadcast(v.obs.select("sample_id", "condition").distinct()), "sample_id").groupBy("condition", "cluster_id").agg(F.round(F.avg("share"), 6).alias("mean_share"))


@query("sample_covariates", "--with o AS (SELECT *, CASE WHEN cell_id % 5 != 0 THEN cluster_id END AS c FROM obs) SELECT sample_id, arg_min(c, cell_id) FILTER (c IS NOT NULL) AS c, min(condition) AS condition, count(DISTINCT c) AS n_c FROM o GROUP BY 1")
def sample_covariates(v: Views):
    rows = v.obs.withColumn("c", F.when(F.col("cell_id") % 5 != 0, F.col("cluster_id")))
    return pseudobulk.covariates(rows, "sample_id", ["c", "condition"]).select("sample_id", "c", "condition", "n_c")


@query("samples_per_level", "SELECT condition, count(DISTINCT sample_id) AS n_samples FROM obs GROUP BY 1")
def samples_per_level(v: Views):
    return pseudobulk.require_samples(v.obs, "sample_id", "condition", 2)


@query("majority_label", "--with o AS (SELECT *, cell_id % 3 = 0 AS m FROM obs), k AS (SELECT sample_id, cluster_id, count(*) AS n FROM o WHERE m GROUP BY 1, 2), t AS (SELECT sample_id, cluster_id FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY n DESC, cluster_id) AS r FROM k) WHERE r = 1), n AS (SELECT sample_id, count(*) AS n_cells, count(*) FILTER (m) AS n_masked FROM o GROUP BY 1) SELECT sample_id, n_cells, n_masked, CASE WHEN n_masked < 18 OR n_masked < 0.1 * n_cells OR cluster_id IS NULL THEN 'Unknown' ELSE cluster_id END AS label FROM n LEFT JOIN t USING (sample_id)")
def majority_label(v: Views):
    return pseudobulk.majority(v.obs.withColumn("m", F.col("cell_id") % 3 == 0), "sample_id", "cluster_id", "m", 18, 0.1)


@query("dominant_level", "--with k AS (SELECT cluster_id, condition, count(*) AS n FROM obs GROUP BY 1, 2) SELECT cluster_id, condition AS label FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, condition) AS r FROM k) WHERE r = 1")
def dominant_level(v: Views):
    return pseudobulk.majority(v.obs, "cluster_id", "condition", None, 0, 0.0).select("cluster_id", "label")


@query("label_flow", "--with k AS (SELECT cluster_id, condition, count(*) AS n FROM obs GROUP BY 1, 2), s AS (SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY cluster_id) AS share FROM k) SELECT cluster_id, condition, n, round(share, 6) AS share FROM s WHERE share >= 0.2")
def label_flow(v: Views):
    return pseudobulk.flow(v.obs, "cluster_id", "condition", 0.2).withColumn("share", F.round("share", 6))


@query("batch_composition", "--with k AS (SELECT cluster_id, sample_id, count(*) AS n FROM obs GROUP BY 1, 2) SELECT cluster_id, sample_id, n, round(n::DOUBLE / sum(n) OVER (PARTITION BY cluster_id), 6) AS share FROM k")
def batch_composition(v: Views):
    return pseudobulk.flow(v.obs, "cluster_id", "sample_id").withColumn("share", F.round("share", 6))


@query("sample_heatmap", "--with m AS (SELECT sample_id, gene_id, sum(value) / n AS mean FROM counts JOIN obs USING (cell_id) JOIN (SELECT sample_id, count(*) AS n FROM obs GROUP BY 1) USING (sample_id) GROUP BY 1, 2, n) SELECT sample_id, gene_id, round(mean, 6) AS mean, round(greatest(-3, least(3, CASE WHEN stddev_pop(mean) OVER w > 0 THEN (mean - avg(mean) OVER w) / stddev_pop(mean) OVER w ELSE 0 END))::DOUBLE, 6) AS z FROM m WINDOW w AS (PARTITION BY gene_id)")
def sample_heatmap(v: Views):
    return pseudobulk.heatmap(v.counts, v.obs, "sample_id").select("sample_id", "gene_id", r6("mean", "mean"), r6("z", "z"))


@query("score_summary", "--with l AS (SELECT cluster_id, 'a' AS module, total_counts::DOUBLE AS score FROM cells UNION ALL SELECT cluster_id, 'b', n_genes::DOUBLE FROM cells), s AS (SELECT cluster_id, module, avg(score) AS mean, median(score) AS median, count(*) AS n_cells FROM l GROUP BY 1, 2) SELECT cluster_id, module, round(mean, 6) AS mean, round(median, 6) AS median, n_cells, round(CASE WHEN stddev_pop(mean) OVER w > 0 THEN (mean - avg(mean) OVER w) / stddev_pop(mean) OVER w ELSE 0 END, 6) AS z FROM s WINDOW w AS (PARTITION BY module)")
def score_summary(v: Views):
    rows = v.cells.select("cluster_id", F.col("total_counts").alias("a"), F.col("n_genes").alias("b"))
    return pseudobulk.score_summary(rows, "cluster_id", ["a", "b"]).select("cluster_id", "module", r6("mean", "mean"), r6("median", "median"), "n_cells", r6("z", "z"))


@query("stat_matrix", "--with t AS (SELECT cluster_id, gene_id, CASE WHEN n % 3 = 0 THEN NULL ELSE s END AS stat, s / 2 AS score FROM (SELECT cluster_id, gene_id, sum(value) AS s, count(*) AS n FROM counts JOIN obs USING (cell_id) WHERE gene_id < 'Brand#33' OR cluster_id < 'F' GROUP BY 1, 2)), g AS (SELECT * FROM (SELECT DISTINCT cluster_id FROM t), (SELECT DISTINCT gene_id FROM t)) SELECT cluster_id, gene_id, coalesce(avg(coalesce(stat, score)), 0) AS stat FROM g LEFT JOIN t USING (cluster_id, gene_id) GROUP BY 1, 2")
def stat_matrix(v: Views):
    rows = v.counts.join(v.obs, "cell_id").where("gene_id < 'Brand#33' or cluster_id < 'F'").groupBy("cluster_id", "gene_id").agg(F.sum("value").alias("s"), F.count("*").alias("n"))
    rows = rows.select("cluster_id", "gene_id", F.when(F.col("n") % 3 != 0, F.col("s")).alias("stat"), (F.col("s") / 2).alias("score"))
    return pseudobulk.stat_matrix(rows, "cluster_id", "gene_id", ["stat", "score"])


@query("contrast_assembly", "--with a AS (SELECT gene_id, sum(value) AS pb FROM pb WHERE gene_id < 'Brand#35' GROUP BY 1), b AS (SELECT gene_id, count(*) AS wx FROM counts WHERE gene_id > 'Brand#22' GROUP BY 1), c AS (SELECT gene_id, max(value) AS lr FROM counts WHERE gene_id LIKE '%3' GROUP BY 1) SELECT gene_id, pb, wx, lr FROM a FULL JOIN b USING (gene_id) FULL JOIN c USING (gene_id)")
def contrast_assembly(v: Views):
    a = v.pb.where("gene_id < 'Brand#35'").groupBy("gene_id").agg(F.sum("value").alias("pb"))
    b = v.counts.where("gene_id > 'Brand#22'").groupBy("gene_id").agg(F.count("*").alias("wx"))
    c = v.counts.where("gene_id like '%3'").groupBy("gene_id").agg(F.max("value").alias("lr"))
    return merge.contrast_table(a, b, c, ["gene_id"])


@query("metabolite_annotation", "--with e AS (SELECT p_partkey, p_name, p_size FROM part), a AS (SELECT p_size, min(p_type) AS c FROM part WHERE p_size <= 25 GROUP BY 1), b AS (SELECT lower(trim(p_name)) AS n, min(p_brand) AS c FROM part GROUP BY 1) SELECT p_partkey, coalesce(a.c, b.c) AS class FROM e LEFT JOIN a USING (p_size) LEFT JOIN b ON lower(trim(p_name)) = n")
def metabolite_annotation(v: Views):
    part = v.table("part")
    one = part.where("p_size <= 25").select("p_size", F.col("p_type").alias("class"))
    two_ = part.select("p_name", F.col("p_brand").alias("class"))
    return merge.annotate_with_fallback(part.select("p_partkey", "p_name", "p_size"), one, two_, "p_size", "p_name", "class").select("p_partkey", "class")


@query("event_dedupe", "--with r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value, event_id) AS k FROM events) SELECT event_id, user_id, event_type FROM r WHERE k = 1 ORDER BY value, event_id LIMIT 200")
def event_dedupe(v: Views):
    rows = v.table("events").select("event_id", "user_id", "event_type", F.struct("value", "event_id").alias("prior"))
    kept = merge.first_by_prior(rows, ["user_id", "event_type"], "prior", True)
    return kept.orderBy("prior").limit(200).select("event_id", "user_id", "event_type")


@query("sample_intersection", "SELECT sample_id FROM obs WHERE cluster_id = 'BUILDING' INTERSECT SELECT sample_id FROM obs WHERE cluster_id = 'MACHINERY'")
def sample_intersection(v: Views):
    of = lambda c: v.obs.where(F.col("cluster_id") == c).select("sample_id")
    return of("BUILDING").intersect(of("MACHINERY"))


@query("prune_top", "--with r AS (SELECT cluster_id, gene_id, sum(value) AS s FROM pb GROUP BY 1, 2) SELECT cluster_id, gene_id, s FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY s DESC, gene_id) AS k FROM r) WHERE k <= 5")
def prune_top(v: Views):
    rows = v.pb.groupBy("cluster_id", "gene_id").agg(F.sum("value").alias("s"))
    return qc.top_k(rows, 5, ["cluster_id"], F.desc("s"), F.col("gene_id"))
