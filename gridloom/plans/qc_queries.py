"""Quality, filters and normalisation over the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import qc
from .registry import query
from .views import Views, r6


@query("qc_cell_metrics", "SELECT cell_id, sample_id, total_counts, n_genes, round(pct_mt, 6) AS pct_mt FROM cells")
def qc_cell_metrics(v: Views):
    return v.cells.select("cell_id", "sample_id", "total_counts", "n_genes", r6("pct_mt", "pct_mt"))


@query("qc_gene_metrics", """SELECT gene_id, count(*) AS n_cells, sum(value) AS total_counts, round(sum(value) / (SELECT count(*) FROM obs), 6) AS mean_counts,
  round(100.0::DOUBLE * (1.0 - count(*)::DOUBLE / (SELECT count(*) FROM obs)), 6) AS pct_dropout FROM counts GROUP BY 1""")
def qc_gene_metrics(v: Views):
    return qc.gene_metrics(v.counts, v.obs).select("gene_id", "n_cells", "total_counts", r6("mean_counts", "mean_counts"), r6("pct_dropout", "pct_dropout"))


_CUTS = """--with m AS (SELECT sample_id, median(total_counts) AS med FROM cells GROUP BY 1),
s AS (SELECT sample_id, min(med) AS median, median(abs(total_counts - med)) AS mad, quantile_cont(total_counts, 0.05) AS q, quantile_cont(total_counts, 0.01) AS gate FROM cells JOIN m USING (sample_id) GROUP BY 1),
k AS (SELECT *, CASE WHEN gate < 1000 THEN CAST(ceil(greatest(median - 2.0 * mad, q, 0)) AS BIGINT) END AS auto_cutoff FROM s)
"""


@query("qc_lower_cutoffs", _CUTS + "SELECT sample_id, round(median, 6) AS median, round(mad, 6) AS mad, auto_cutoff, greatest(100, auto_cutoff)::BIGINT AS cutoff FROM k")
def qc_lower_cutoffs(v: Views):
    found = qc.lower_cutoffs(v.cells, ["sample_id"], min_counts=100, mads=2.0, quantile=0.05)
    return found.select("sample_id", r6("median", "median"), r6("mad", "mad"), "auto_cutoff", "cutoff")


@query("qc_upper_cutoffs", """--with m AS (SELECT sample_id, median(n_genes) AS med FROM cells GROUP BY 1),
s AS (SELECT sample_id, min(med) AS median, median(abs(n_genes - med)) AS mad, quantile_cont(n_genes, 0.99) AS q FROM cells JOIN m USING (sample_id) GROUP BY 1)
SELECT sample_id, round(least(CASE WHEN mad > 0 THEN median + 3.0 * mad END, q)::DOUBLE, 6) AS cutoff FROM s""")
def qc_upper_cutoffs(v: Views):
    return qc.upper_cutoffs(v.cells, "n_genes", ["sample_id"], mads=3.0, quantile=0.99).select("sample_id", r6("cutoff", "cutoff"))


def cascade_of(v: Views):
    return qc.cascade(v.cells, ["sample_id"], min_genes=5, lower={"min_counts": 50, "mads": 2.0, "quantile": 0.05}, max_pct=("pct_mt", 35.0), genes_mad=3.0, genes_quantile=0.99, counts_mad=3.0, counts_quantile=0.99)


_CASCADE = """--with c1 AS (SELECT *, n_genes < 5 AS f1 FROM cells),
m2 AS (SELECT sample_id, median(total_counts) AS med, quantile_cont(total_counts, 0.05) AS q, quantile_cont(total_counts, 0.01) AS gate FROM c1 WHERE NOT f1 GROUP BY 1),
d2 AS (SELECT sample_id, min(med) AS med, min(q) AS q, min(gate) AS gate, median(abs(total_counts - med)) AS mad FROM c1 JOIN m2 USING (sample_id) WHERE NOT f1 GROUP BY 1),
k2 AS (SELECT sample_id, greatest(50, CASE WHEN gate < 1000 THEN CAST(ceil(greatest(med - 2.0 * mad, q, 0)) AS BIGINT) END) AS cut FROM d2),
c2 AS (SELECT c1.*, CASE WHEN f1 THEN '1:min_genes' WHEN total_counts < cut THEN '2:min_counts' WHEN pct_mt > 35.0 THEN '3:pct_mt' END AS f FROM c1 LEFT JOIN k2 USING (sample_id)),
m4 AS (SELECT sample_id, median(n_genes) AS med, quantile_cont(n_genes, 0.99) AS q FROM c2 WHERE f IS NULL GROUP BY 1),
k4 AS (SELECT sample_id, least(CASE WHEN median(abs(n_genes - med)) > 0 THEN min(med) + 3.0 * median(abs(n_genes - med)) END, min(q)) AS cut4 FROM c2 JOIN m4 USING (sample_id) WHERE f IS NULL GROUP BY 1),
c4 AS (SELECT c2.* EXCLUDE (f), CASE WHEN f IS NOT NULL THEN f WHEN n_genes > cut4 THEN '4:max_genes' END AS f FROM c2 LEFT JOIN k4 USING (sample_id)),
m5 AS (SELECT sample_id, median(total_counts) AS med, quantile_cont(total_counts, 0.99) AS q FROM c4 WHERE f IS NULL GROUP BY 1),
k5 AS (SELECT sample_id, least(CASE WHEN median(abs(total_counts - med)) > 0 THEN min(med) + 3.0 * median(abs(total_counts - med)) END, min(q)) AS cut5 FROM c4 JOIN m5 USING (sample_id) WHERE f IS NULL GROUP BY 1),
failed AS (SELECT c4.* EXCLUDE (f), CASE WHEN f IS NOT NULL THEN f WHEN total_counts > cut5 THEN '5:max_counts' END AS failed_at FROM c4 LEFT JOIN k5 USING (sample_id))
"""
STEPS = ["1:min_genes", "2:min_counts", "3:pct_mt", "4:max_genes", "5:max_counts"]


@query("qc_cascade", _CASCADE + "SELECT cell_id, sample_id, failed_at FROM failed")
def qc_cascade(v: Views):
    return cascade_of(v).select("cell_id", "sample_id", "failed_at")


@query("qc_cascade_log", _CASCADE + """, s AS (SELECT unnest(['1:min_genes', '2:min_counts', '3:pct_mt', '4:max_genes', '5:max_counts']) AS filter),
b AS (SELECT 'ALL' AS batch, failed_at FROM failed UNION ALL SELECT sample_id, failed_at FROM failed),
g AS (SELECT filter, batch, count(*) FILTER (failed_at IS NULL OR failed_at >= filter) AS n_before, count(*) FILTER (failed_at = filter) AS n_removed FROM b, s GROUP BY 1, 2)
SELECT filter, batch, n_before, n_before - n_removed AS n_after, n_removed, round(n_removed::DOUBLE / nullif(n_before, 0), 6) AS frac_removed FROM g""")
def qc_cascade_log(v: Views):
    return qc.cascade_log(cascade_of(v), "sample_id", STEPS).withColumn("frac_removed", F.round("frac_removed", 6))


@query("qc_filter_stack", _CASCADE + """, s AS (SELECT unnest(['1:min_genes', '2:min_counts', '3:pct_mt', '4:max_genes', '5:max_counts']) AS filter),
g AS (SELECT filter, sample_id AS batch, count(*) FILTER (failed_at IS NULL OR failed_at >= filter) AS n_before, count(*) FILTER (failed_at = filter) AS n_removed FROM failed, s GROUP BY 1, 2),
a AS (SELECT filter, avg(n_before) AS mb, sum(n_removed) AS r FROM g GROUP BY 1)
SELECT filter, row_number() OVER (ORDER BY mb DESC, filter) AS place, round(r::DOUBLE / (SELECT count(*) FROM failed), 6) AS frac_of_original FROM a""")
def qc_filter_stack(v: Views):
    log = qc.cascade_log(cascade_of(v), "sample_id", STEPS).where("batch != 'ALL'")
    return qc.filter_stack(log).withColumn("frac_of_original", F.round("frac_of_original", 6))


@query("qc_sample_summary", _CASCADE + """SELECT sample_id, count(*) AS n_before, count(*) FILTER (failed_at IS NULL) AS n_after, round(median(total_counts), 6) AS median_counts,
 round(count(*) FILTER (failed_at IS NOT NULL)::DOUBLE / count(*), 6) AS frac_removed FROM failed GROUP BY 1""")
def qc_sample_summary(v: Views):
    """The flagship: triples to metrics to robust thresholds to survivors, per sample."""
    left = F.col("failed_at").isNull().cast("long")
    return cascade_of(v).groupBy("sample_id").agg(F.count("*").alias("n_before"), F.sum(left).alias("n_after"), F.round(F.median("total_counts"), 6).alias("median_counts"), F.round(F.sum(1 - left) / F.count("*"), 6).alias("frac_removed"))


@query("qc_min_cells", """--with k AS (SELECT gene_id, count(*) AS n_cells FROM counts JOIN (SELECT cell_id FROM cells WHERE n_genes >= 5) USING (cell_id) GROUP BY 1)
SELECT gene_id, n_cells, n_cells >= 10 AS kept FROM k""")
def qc_min_cells(v: Views):
    survivors = v.cells.where("n_genes >= 5").select("cell_id")
    return v.counts.join(survivors, "cell_id", "left_semi").groupBy("gene_id").agg(F.count("*").alias("n_cells")).withColumn("kept", F.col("n_cells") >= 10)


@query("qc_large_samples", "--with k AS (SELECT sample_id FROM obs GROUP BY 1 HAVING count(*) >= 60) SELECT sample_id, count(*) AS n FROM obs WHERE sample_id IN (FROM k) GROUP BY 1")
def qc_large_samples(v: Views):
    return qc.large_groups(v.obs, "sample_id", 60).groupBy("sample_id").agg(F.count("*").alias("n"))


_DOUBLETS = """--with d AS (SELECT *, (cell_id * 7919 % 1000) / 1000.0::DOUBLE AS doublet_score FROM obs),
c AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY doublet_score DESC, cell_id) <= greatest(1, ceil(0.06::DOUBLE * count(*) OVER (PARTITION BY sample_id))) AS predicted_doublet FROM d)
"""


def doublets_of(v: Views):
    scored = v.obs.withColumn("doublet_score", (F.col("cell_id") * 7919 % 1000) / F.lit(1000.0))
    return qc.call_doublets(scored, "sample_id", 0.06)


@query("qc_doublets", _DOUBLETS + "SELECT cell_id, predicted_doublet FROM c")
def qc_doublets(v: Views):
    return doublets_of(v).select("cell_id", "predicted_doublet")


@query("qc_doublet_stats", _DOUBLETS + "SELECT sample_id, count(*) AS n_cells, count(*) FILTER (predicted_doublet) AS n_doublets, min(doublet_score) FILTER (predicted_doublet) AS threshold, round(count(*) FILTER (predicted_doublet)::DOUBLE / count(*), 6) AS rate FROM c GROUP BY 1")
def qc_doublet_stats(v: Views):
    return qc.doublet_stats(doublets_of(v), "sample_id").withColumn("rate", F.round("rate", 6))


@query("qc_doublet_removal", _DOUBLETS + ", k AS (SELECT sample_id, count(*) AS n_cells FROM c WHERE NOT predicted_doublet GROUP BY 1) SELECT * FROM k WHERE n_cells >= 20")
def qc_doublet_removal(v: Views):
    return qc.large_groups(doublets_of(v).where("not predicted_doublet"), "sample_id", 20).groupBy("sample_id").agg(F.count("*").alias("n_cells"))


@query("lognorm_layer", """--with t AS (SELECT cell_id, sum(value) AS total FROM counts GROUP BY 1)
SELECT cell_id, gene_id, round(ln(1 + value * (CASE WHEN total > 0 THEN 10000.0::DOUBLE / total ELSE 1 END)), 6) AS value FROM counts JOIN t USING (cell_id)""")
def lognorm_layer(v: Views):
    return qc.lognorm(v.counts, 1e4).withColumn("value", F.round("value", 6))


@query("normalize_total", """--with t AS (SELECT cell_id, sum(value) AS total FROM counts GROUP BY 1), g AS (SELECT median(total) AS goal FROM t WHERE total > 0)
SELECT gene_id, round(sum(ln(1 + value * goal / total)), 4) AS total FROM counts JOIN t USING (cell_id), g GROUP BY 1""")
def normalize_total(v: Views):
    return qc.lognorm(v.counts, None).groupBy("gene_id").agg(F.round(F.sum("value"), 4).alias("total"))


@query("variable_genes", """--with t AS (SELECT cell_id, sum(value) AS total FROM counts GROUP BY 1),
l AS (SELECT cell_id, gene_id, ln(1 + value * 10000.0::DOUBLE / total) AS value FROM counts JOIN t USING (cell_id)),
n AS (SELECT count(*)::DOUBLE AS n FROM obs),
g AS (SELECT gene_id, sum(value) / min(n) AS mean, (sum(value * value) - min(n) * (sum(value) / min(n)) * (sum(value) / min(n))) / (min(n) - 1) AS variance FROM l, n GROUP BY 1),
b AS (SELECT *, variance / mean AS dispersion, ntile(5) OVER (ORDER BY mean, gene_id) AS bin FROM g WHERE mean > 0),
s AS (SELECT *, CASE WHEN stddev_samp(dispersion) OVER w > 0 THEN (dispersion - avg(dispersion) OVER w) / stddev_samp(dispersion) OVER w ELSE 0 END AS score FROM b WINDOW w AS (PARTITION BY bin))
SELECT gene_id, bin::INTEGER AS bin, round(score, 6) AS score, row_number() OVER (ORDER BY round(score, 9) DESC, gene_id) <= 8 AS highly_variable FROM s""")
def variable_genes(v: Views):
    return qc.variable_genes(qc.lognorm(v.counts, 1e4), v.obs, 8).select("gene_id", "bin", r6("score", "score"), "highly_variable")


_PREV = """--with n AS (SELECT cluster_id, count(*) AS n_cells FROM obs GROUP BY 1),
p AS (SELECT cluster_id, gene_id, count(*) AS n_expr, min(n_cells) AS n_cells, count(*)::DOUBLE / min(n_cells) AS pct FROM counts JOIN obs USING (cell_id) JOIN n USING (cluster_id) GROUP BY 1, 2)
"""


@query("gene_prevalence", _PREV + "SELECT cluster_id, gene_id, n_expr, n_cells, round(pct, 6) AS pct FROM p")
def gene_prevalence(v: Views):
    return qc.prevalence(v.counts, v.obs, "cluster_id").withColumn("pct", F.round("pct", 6))


@query("min_pct_filter", _PREV + """, e AS (SELECT gene_id, sum(n_expr) AS e FROM p GROUP BY 1), a AS (SELECT sum(n_cells) AS a FROM n),
r AS (SELECT p.*, (e - n_expr)::DOUBLE / (a - n_cells) AS pct_rest FROM p JOIN e USING (gene_id), a)
SELECT cluster_id, gene_id, round(pct, 6) AS pct, round(pct_rest, 6) AS pct_rest FROM r WHERE (pct >= 0.5 OR pct_rest >= 0.5) AND abs(pct - pct_rest) >= 0.02""")
def min_pct_filter(v: Views):
    return qc.prevalence_gap(qc.prevalence(v.counts, v.obs, "cluster_id"), "cluster_id", 0.5, 0.02).select("cluster_id", "gene_id", r6("pct", "pct"), r6("pct_rest", "pct_rest"))


@query("expressed_genes", _PREV + "SELECT cluster_id, count(*) FILTER (pct >= 0.55) AS n_expressed FROM p GROUP BY 1")
def expressed_genes(v: Views):
    return qc.prevalence(v.counts, v.obs, "cluster_id").groupBy("cluster_id").agg(F.sum((F.col("pct") >= 0.55).cast("long")).alias("n_expressed"))


@query("library_gene_filter", """--with l AS (SELECT sample_id || '|' || cluster_id AS library, cluster_id AS level FROM libs),
c AS (SELECT sample_id || '|' || cluster_id AS library, gene_id, value FROM pb),
x AS (SELECT gene_id, level, sum(value) AS t, count(*) FILTER (value >= 30) AS h, count(*) FILTER (value > 0) AS o FROM c JOIN l USING (library) GROUP BY 1, 2),
g AS (SELECT gene_id, sum(t) AS total, count(*) FILTER (h >= 5) AS ok, sum(o) AS o FROM x GROUP BY 1),
k AS (SELECT gene_id, total FROM g WHERE total >= 1000 AND ok = (SELECT count(DISTINCT level) FROM l) AND o::DOUBLE / (SELECT count(*) FROM l) >= 0.5)
SELECT gene_id, total, rank FROM (SELECT *, row_number() OVER (ORDER BY total DESC, gene_id) AS rank FROM k) WHERE rank <= 15""")
def library_gene_filter(v: Views):
    libraries = v.libs.select(F.concat_ws("|", "sample_id", "cluster_id").alias("library"), F.col("cluster_id").alias("level"))
    counts = v.pb.select(F.concat_ws("|", "sample_id", "cluster_id").alias("library"), "gene_id", "value")
    return qc.library_gene_filter(libraries, counts, "level", min_total=1000, min_count=30, min_samples=5, min_pct=0.5, max_genes=15)


_PROBA = """--with q AS (SELECT cell_id, cluster_id AS label, 1.0::DOUBLE + (cell_id * 31 % 17) AS w FROM obs UNION ALL SELECT cell_id, gene_id, value / 40.0::DOUBLE FROM counts WHERE gene_id IN ('Brand#11', 'Brand#22')),
proba AS (SELECT cell_id, label, w / sum(w) OVER (PARTITION BY cell_id) AS p FROM q),
o AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY p DESC, label) AS r FROM proba),
e AS (SELECT cell_id, sum(-greatest(1e-12, least(1.0, p)) * ln(greatest(1e-12, least(1.0, p)))) AS entropy, max(label) FILTER (r = 1) AS label, max(p) FILTER (r = 1) - coalesce(max(p) FILTER (r = 2), 0) AS margin FROM o GROUP BY 1)
"""


def probabilities(v: Views):
    from pyspark.sql import Window

    base = v.obs.select("cell_id", F.col("cluster_id").alias("label"), (F.lit(1.0) + F.col("cell_id") * 31 % 17).alias("w"))
    more = v.counts.where("gene_id in ('Brand#11', 'Brand#22')").select("cell_id", F.col("gene_id").alias("label"), (F.col("value") / 40.0).alias("w"))
    return base.unionByName(more).withColumn("p", F.col("w") / F.sum("w").over(Window.partitionBy("cell_id"))).drop("w")


@query("confidence_mask", _PROBA + "SELECT cell_id, label, round(entropy, 6) AS entropy, round(margin, 6) AS margin, entropy <= greatest(0.3, (SELECT quantile_cont(entropy, 0.5) FROM e)) + 1e-12 AND margin >= 0.2 AS confident FROM e")
def confidence_mask(v: Views):
    found = qc.confidence(probabilities(v), entropy_abs=0.3, entropy_quantile=0.5, min_margin=0.2)
    return found.select("cell_id", "label", r6("entropy", "entropy"), r6("margin", "margin"), "confident")


@query("mask_safety", "SELECT CASE WHEN count(*) FILTER (cell_id % 100 < 3) >= 500 AND count(*) FILTER (cell_id % 100 < 3) >= 0.05 * count(*) THEN count(*) FILTER (cell_id % 100 < 3) ELSE count(*) END AS n_kept FROM obs")
def mask_safety(v: Views):
    return qc.safe_mask(v.obs.withColumn("ok", F.col("cell_id") % 100 < 3), "ok").agg(F.sum(F.col("ok").cast("long")).alias("n_kept"))


@query("removed_fraction", """--with a AS (SELECT cell_id, sum(value) AS raw FROM counts GROUP BY 1), b AS (SELECT cell_id, sum(value) AS cb FROM counts_cb GROUP BY 1)
SELECT cell_id, round((raw - cb) / raw, 9) AS removed FROM a JOIN b USING (cell_id)""")
def removed_fraction(v: Views):
    return qc.removed_fraction(v.counts, v.counts_cb).withColumn("removed", F.round("removed", 9))
