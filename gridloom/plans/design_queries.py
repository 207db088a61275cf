"""Tests with designs, composition, compaction by several views, variable genes by batch, gene filters, samples and
subsampling over the views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import composition, enrichment, genes, kernels, merge, nbtests, pseudobulk, qc, ranking, ranktests, rounds, selection
from .kernel_queries import _KNN, members_of, shares_of
from .merge_queries import _SIZE, displayed
from .network_queries import matrix_of, net_of
from .registry import ORACLES, query
from .stat_queries import _COS, cosines
from .views import Views, r6, sql


def _factors(v: Views):
    """Cells with a second factor: the parity of their nation's key."""
    parity = F.when(F.col("n_nationkey") % 2 == 0, "even").otherwise("odd").alias("parity")
    return v.obs.join(F.broadcast(v.table("nation").select(F.col("n_name").alias("sample_id"), parity)), "sample_id")


@query("nb_within_cluster")
def nb_within_cluster(v: Views):
    """Iterative fits; every region against the most frequent one in every cluster."""
    return nbtests.condition_within_cluster(v.counts, v.obs, "sample_id", "cluster_id", "condition", buckets=8)


@query("nb_cluster_versus_rest")
def nb_cluster_versus_rest(v: Views):
    """Iterative fits."""
    return nbtests.cluster_versus_rest(v.counts, v.obs, "sample_id", "cluster_id", covariates=("condition",), buckets=8)


@query("nb_interaction")
def nb_interaction(v: Views):
    """Iterative fits."""
    return nbtests.interaction(v.counts, _factors(v), "sample_id", "cluster_id", ("condition", "ASIA", "EUROPE"), ("parity", "even", "odd"), buckets=8)


_RATIOS = "--with n AS (SELECT s.sample_id, c.cluster_id, count(o.cell_id) AS n, min(s.condition) AS condition FROM (SELECT DISTINCT sample_id, condition FROM obs) s CROSS JOIN (SELECT DISTINCT cluster_id FROM obs) c LEFT JOIN obs o ON o.sample_id = s.sample_id AND o.cluster_id = c.cluster_id GROUP BY 1, 2), p AS (SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY sample_id) AS share FROM n), l AS (SELECT *, ln(share + 1e-6) - avg(ln(share + 1e-6)) OVER (PARTITION BY sample_id) AS clr FROM p)"


@query("composition_ratios", _RATIOS + " SELECT sample_id, cluster_id, n, round(share, 6) AS share, round(clr, 6) AS clr FROM l")
def composition_ratios(v: Views):
    return composition.centred_log_ratios(shares_of(v).drop("share"), "sample_id", "cluster_id").select("sample_id", "cluster_id", "n", r6("share", "share"), r6("clr", "clr"))


@query("composition_pairs", _RATIOS + ", v AS (SELECT DISTINCT condition FROM l) SELECT cluster_id AS cluster, a.condition AS level_ref, b.condition AS level_test, round(log2((avg(share) FILTER (l.condition = b.condition) + 1e-6) / (avg(share) FILTER (l.condition = a.condition) + 1e-6)), 6) AS log2fc, round(avg(clr) FILTER (l.condition = a.condition), 6) AS clr_mean_ref, round(avg(clr) FILTER (l.condition = b.condition), 6) AS clr_mean_test FROM l, v a, v b WHERE a.condition < b.condition GROUP BY 1, 2, 3")
def composition_pairs(v: Views):
    """Without the exact p-values, which the tests hold against enumeration."""
    found = composition.clr_mann_whitney(shares_of(v).drop("share"), "sample_id", "cluster_id", "condition")
    return found.select("cluster", "level_ref", "level_test", r6("log2fc", "log2fc"), r6("clr_mean_ref", "clr_mean_ref"), r6("clr_mean_test", "clr_mean_test"))


@query("composition_tests")
def composition_tests(v: Views):
    """Exact for few samples."""
    return composition.clr_mann_whitney(shares_of(v).drop("share"), "sample_id", "cluster_id", "condition")


@query("neighbourhood_fallbacks")
def neighbourhood_fallbacks(v: Views):
    """Iterative fits."""
    from ..operators import neighbourhoods

    members = members_of(v)
    radius = members.groupBy("seed").agg(F.median("distance").alias("radius"))
    return composition.neighbourhood_test(neighbourhoods.abundance(members, v.emb, "sample", "condition", 1), radius, "sample", "0")


_LABELS = "lab AS (SELECT cluster_id AS cluster, ['one', 'one', 'one', 'Unknown', ' one'][row_number() OVER (ORDER BY cluster_id)] AS label FROM (SELECT DISTINCT cluster_id FROM obs)), nn AS (SELECT cluster_id AS cluster, count(*) AS n_cells FROM obs GROUP BY 1)"
_VIEWS = _COS + f""", {_LABELS}, q AS (SELECT unnest(['pathway', 'regulator', 'sets', 'sets', 'sets']) AS view, unnest(['', '', 'HALLMARK', 'REACTOME', 'other']) AS collection, unnest([0.1, 0.0, 0.2, 0.3, -0.1])::DOUBLE AS shift, unnest([-0.4, -0.5, 0.6, 0.45, 0.5])::DOUBLE AS floor),
g AS (SELECT view, collection, floor, c.a, c.b, coalesce(cosine, 0) + shift * (CASE WHEN c.a < 'C' THEN 1 ELSE -1 END) AS cosine FROM c, q JOIN lab x ON x.cluster = c.a JOIN lab y ON y.cluster = c.b WHERE trim(x.label) = 'one' AND trim(y.label) = 'one'),
t AS (SELECT *, cosine >= least(0.98::DOUBLE, greatest(floor, quantile_cont(cosine, 0.9) OVER (PARTITION BY view, collection))) AS p FROM g),
r AS (SELECT a, b, bool_or(p) FILTER (view = 'pathway') AS pass_pathway, bool_or(p) FILTER (view = 'regulator') AS pass_regulator, count(*) FILTER (view = 'sets') AS n_collections, count(*) FILTER (view = 'sets' AND p) AS n_passed FROM t GROUP BY 1, 2)"""


def _views(v: Views):
    shift = F.when(F.col("a") < "C", 1.0).otherwise(-1.0)
    kinds = v.spark.createDataFrame([("pathway", "", 0.1), ("regulator", "", 0.0), ("sets", "HALLMARK", 0.2), ("sets", "REACTOME", 0.3), ("sets", "other", -0.1)], "view string, collection string, shift double")
    pairs = cosines(v).crossJoin(F.broadcast(kinds)).withColumn("cosine", F.col("cosine") + F.col("shift") * shift)
    sizes = v.obs.groupBy(F.col("cluster_id").alias("cluster")).agg(F.count("*").alias("n_cells"))
    name = F.get(F.array(*(F.lit(x) for x in ("one", "one", "one", "Unknown", " one"))), F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("cluster")) - 1)
    labels = sizes.withColumn("label", name)
    return selection.compaction_views(pairs, labels, {"pathway": -0.4, "regulator": -0.5}), labels


@query("compaction_views", _VIEWS + " SELECT a, b, pass_pathway, pass_regulator, n_collections, n_passed, 3::BIGINT AS n_needed, pass_pathway AND pass_regulator AND n_passed >= 3 AS passes FROM r")
def compaction_views(v: Views):
    return _views(v)[0].select("a", "b", "pass_pathway", "pass_regulator", "n_collections", "n_passed", "n_needed", "passes")


_GROUPS = """, edge AS (SELECT a AS x, b AS y FROM {edges} UNION ALL SELECT b, a FROM {edges}), reach(x, y) AS (SELECT cluster, cluster FROM nn UNION SELECT reach.x, edge.y FROM reach JOIN edge ON reach.y = edge.x),
root AS (SELECT x, min(y) AS root FROM reach GROUP BY 1), size AS (SELECT root, sum(n_cells) AS size FROM root JOIN nn ON nn.cluster = root.x GROUP BY 1), num AS (SELECT root, 'C' || lpad((row_number() OVER (ORDER BY size DESC, root) - 1)::VARCHAR, 2, '0') AS code FROM size)
SELECT x AS cluster_id, code FROM root JOIN num USING (root)"""


@query("compacted_round")
def compacted_round(v: Views):
    """Follows from ``compaction_views``; the grouping of few clusters runs on the driver."""
    judged, labels = _views(v)
    return selection.compacted_round(judged, labels).withColumnRenamed("cluster", "cluster_id")


_HVG = """--with t AS (SELECT cell_id, sum(value) AS total FROM counts GROUP BY 1), x AS (SELECT cell_id, gene_id, value * 10000.0::DOUBLE / total AS value FROM counts JOIN t USING (cell_id)),
c AS (SELECT cell_id, {batch} AS batch FROM obs), n AS (SELECT batch, count(*)::DOUBLE AS n FROM c GROUP BY 1),
m AS (SELECT batch, gene_id, sum(value) / n AS m, (sum(value * value) - n * (sum(value) / n) * (sum(value) / n)) / (n - 1) AS v FROM x JOIN c USING (cell_id) JOIN n USING (batch) GROUP BY 1, 2, n),
d AS (SELECT batch, gene_id, ln(1 + m) AS mean, ln(v / m) AS dispersion FROM m WHERE m > 0 AND v > 0),
b AS (SELECT *, least(20, greatest(1, ceil(round((mean - min(mean) OVER w) / ((max(mean) OVER w - min(mean) OVER w) / 20), 9)))) AS bin FROM d WINDOW w AS (PARTITION BY batch)),
s AS (SELECT *, CASE WHEN count(*) OVER w = 1 THEN 1.0 ELSE coalesce((dispersion - avg(dispersion) OVER w) / stddev_samp(dispersion) OVER w, 0) END AS score FROM b WINDOW w AS (PARTITION BY batch, bin)),
f AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY round(score, 9) DESC, gene_id) <= 8 AS first FROM s),
g AS (SELECT gene_id, count(*) FILTER (first) AS n_batches, sum(score) / (SELECT count(*) FROM n) AS score FROM f GROUP BY 1)
SELECT gene_id, n_batches, round(score, 6) AS score, row_number() OVER (ORDER BY n_batches DESC, round(score, 9) DESC, gene_id) <= 8 AS highly_variable FROM g"""


@query("dispersion_genes", _HVG.format(batch="'all'"))
def dispersion_genes(v: Views):
    return qc.dispersion_genes(qc.lognorm(v.counts, 1e4), v.obs, 8).select("gene_id", "n_batches", r6("score", "score"), "highly_variable")


@query("dispersion_genes_by_batch", _HVG.format(batch="condition"))
def dispersion_genes_by_batch(v: Views):
    return qc.dispersion_genes(qc.lognorm(v.counts, 1e4), v.obs, 8, "condition").select("gene_id", "n_batches", r6("score", "score"), "highly_variable")


@query("gene_filter_expression", "SELECT gene_id, gene_type AS biotype FROM var WHERE lower(replace(gene_type, '-', '_')) NOT IN ('promo', 'large') AND (gene_id < 'Brand#40' OR gene_id IN ('Brand#55', 'brand'))")
def gene_filter_expression(v: Views):
    """The gene's type under another name, lists, and, or."""
    entries = ["expr=biotype not_in ['PROMO', 'Large'];condition_key=sex", "gene_id < 'Brand#40' or gene_id in [\"Brand#55\", 'brand']"]
    return genes.filter_genes(v.var, entries).select("gene_id", "biotype")


@query("gene_metadata", "SELECT p_name || ' ' || p_partkey AS gene_id, CASE WHEN p_partkey % 5 = 0 THEN p_type WHEN upper(p_name) LIKE 'MT-%' THEN 'Mt' WHEN upper(p_name) LIKE 'LINC%' THEN 'lincRNA' ELSE 'protein_coding' END AS gene_type, CASE WHEN p_partkey % 5 = 0 THEN 'chr' || (p_size % 3) END AS chromosome FROM part WHERE p_partkey <= 200")
def gene_metadata(v: Views):
    part = v.table("part").where("p_partkey <= 200").withColumn("p_name", F.concat_ws(" ", "p_name", "p_partkey"))
    known = part.where("p_partkey % 5 = 0").select(F.col("p_name").alias("gene_id"), F.col("p_type").alias("biotype"), F.concat(F.lit("chr"), (F.col("p_size") % 3).cast("string")).alias("chrom"))
    return genes.resolve_metadata(part.select(F.col("p_name").alias("gene_id")), {"gene_type", "chromosome"}, known).select("gene_id", "gene_type", "chromosome")


@query("subset_summary", _SIZE + "SELECT CASE WHEN code IN ('C00', 'C01') THEN 'large' ELSE 'small' END AS subset, count(*) AS n_cells, count(DISTINCT code) AS n_clusters FROM obs JOIN d USING (cluster_id) WHERE code <= 'C03' GROUP BY 1")
def subset_summary(v: Views):
    mapping = v.spark.createDataFrame([("C00", "large"), ("C01", "large"), ("C02", "small"), ("C03", "small")], "code string, subset string")
    return merge.subset_summary(merge.subset_by_clusters(displayed(v), mapping, "display"))


@query("two_level_sample", "SELECT cell_id, condition FROM (SELECT *, row_number() OVER (PARTITION BY condition ORDER BY md5('5|' || cell_id), cell_id) AS k FROM obs WHERE condition IN ('ASIA', 'EUROPE')) WHERE k <= 20")
def two_level_sample(v: Views):
    return ranking.two_levels(v.obs, "condition", "ASIA", "EUROPE", 20, "5")[0].select("cell_id", "condition")


@query("proportional_sample", """--with n AS (SELECT sample_id, count(*) AS n FROM obs GROUP BY 1), s AS (SELECT *, n * 60.0::DOUBLE / sum(n) OVER () AS share FROM n), b AS (SELECT *, least(n, greatest(floor(share), 1))::BIGINT AS base FROM s),
l AS (SELECT *, 60 - sum(base) OVER () AS left_over, row_number() OVER (ORDER BY (base < n) DESC, round(share - base, 9) DESC, sample_id) AS k FROM b), t AS (SELECT sample_id, base + CASE WHEN k <= left_over AND base < n THEN 1 ELSE 0 END AS take FROM l)
SELECT cell_id, sample_id FROM (SELECT cell_id, sample_id, take, row_number() OVER (PARTITION BY sample_id ORDER BY md5('3|' || cell_id), cell_id) AS r FROM obs JOIN t USING (sample_id)) WHERE r <= take""")
def proportional_sample(v: Views):
    return ranking.proportional(v.obs, "sample_id", 60, "3").select("cell_id", "sample_id")


@query("sorted_results", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer ORDER BY c_nationkey, c_acctbal DESC, c_custkey LIMIT 25")
def sorted_results(v: Views):
    """A missing column is skipped."""
    rows = v.table("customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return ranking.sort_results(rows, [("specificity_rank", True), ("c_nationkey", True), ("c_acctbal", False)], ["c_custkey"]).limit(25)


_DRAW = "('0x' || substr(md5('0|' || r || '|' || cell_id), 1, 12))::BIGINT / 281474976710656.0::DOUBLE < 0.8"


@query("subsample_stability", f"--with d AS (SELECT r AS repeat, cell_id, label, CASE WHEN cell_id % (11 + r) = 0 THEN -1 ELSE label END AS again FROM emb, range(5) u(r) WHERE {_DRAW}), n AS (SELECT repeat, label, again, count(*)::DOUBLE AS n FROM d GROUP BY ALL), s AS (SELECT repeat, sum(n * (n - 1) / 2) AS ij, sum(n) AS t FROM n GROUP BY 1), a AS (SELECT repeat, sum(x * (x - 1) / 2) AS a FROM (SELECT repeat, sum(n) AS x FROM n GROUP BY repeat, label) GROUP BY 1), b AS (SELECT repeat, sum(x * (x - 1) / 2) AS b FROM (SELECT repeat, sum(n) AS x FROM n GROUP BY repeat, again) GROUP BY 1) SELECT repeat, round((ij - a * b / (t * (t - 1) / 2)) / ((a + b) / 2 - a * b / (t * (t - 1) / 2)), 6) AS ari FROM s JOIN a USING (repeat) JOIN b USING (repeat)")
def subsample_stability(v: Views):
    """Five draws of four cells in five; the second labels stand for those of a clustering of each draw."""
    again = lambda drawn: drawn.select("repeat", "cell_id", F.when(F.col("cell_id") % (11 + F.col("repeat")) == 0, -1).otherwise(F.col("label")))
    return selection.subsample_stability(v.emb, "label", again).withColumn("ari", F.round("ari", 6))


@query("round_projection", "SELECT unnest(['r0_start', 'r1_secondary_integration_projection']) AS round_id, unnest([NULL, 'r0_start']) AS parent_round_id, unnest(['base', 'projection']) AS round_type, unnest([false, true]) AS active, count(*) AS n FROM obs")
def round_projection(v: Views):
    table = v.spark.createDataFrame([], "round_id string, parent_round_id string, round_type string, best_resolution double, active boolean")
    table = rounds.register(table, "r0_start", None, "base", 0.4)
    table, labels, _ = rounds.project(table, v.obs.select(F.lit("r0_start").alias("round_id"), "cell_id", "cluster_id"), "r0_start", "X_second")
    return table.join(labels.groupBy("round_id").agg(F.count("*").alias("n")), "round_id").select("round_id", "parent_round_id", "round_type", "active", "n")


@query("round_description", "SELECT 'r0' AS round_id, cluster_id, count(*) AS n_cells, cluster_id AS mapped_id, cluster_id AS renumbered_id FROM obs GROUP BY 2")
def round_description(v: Views):
    return rounds.described(v.obs.select(F.lit("r0").alias("round_id"), "cell_id", "cluster_id"), "r0")


@query("activity_mlm")
def activity_mlm(v: Views):
    """Normal equations by the pseudo-inverse; held against least squares in the tests."""
    return enrichment.multivariate(matrix_of(v), net_of(v), "cluster_id")


@query("expression_dots", "--with n AS (SELECT cluster_id, count(*) AS n FROM obs GROUP BY 1) SELECT cluster_id, gene_id, round(sum(value) / n, 6) AS mean, round(count(*)::DOUBLE / n, 6) AS fraction FROM counts JOIN obs USING (cell_id) JOIN n USING (cluster_id) WHERE gene_id IN ('Brand#11', 'Brand#12') GROUP BY 1, 2, n")
def expression_dots(v: Views):
    """What a dot plot of genes by groups shows."""
    return pseudobulk.means(v.counts.where("gene_id in ('Brand#11', 'Brand#12')"), v.obs, "cluster_id").select("cluster_id", "gene_id", r6("mean", "mean"), r6("fraction", "fraction"))


@query("community_labels")
def community_labels(v: Views):
    """Label propagation over the nearest neighbours of all cells; iterative."""
    near = kernels.nearest(v.emb, v.emb, 6).where("query != neighbour")
    return selection.label_propagation(near.select(F.col("query").alias("a"), F.col("neighbour").alias("b"), (1.0 / (1.0 + F.col("distance"))).alias("weight"))).select("node", "community")


@query("subset_refresh", "--with l AS (SELECT 'r0' AS round_id, cell_id, cluster_id FROM obs UNION ALL SELECT 'r1', cell_id, condition FROM obs), n AS (SELECT round_id, cluster_id, count(*) AS n_cells FROM l WHERE cell_id % 3 = 0 GROUP BY 1, 2) SELECT round_id, cluster_id, n_cells, row_number() OVER (PARTITION BY round_id ORDER BY n_cells DESC, cluster_id) - 1 AS cluster_rank FROM n")
def subset_refresh(v: Views):
    labels = v.obs.select(F.lit("r0").alias("round_id"), "cell_id", "cluster_id").unionByName(v.obs.select(F.lit("r1").alias("round_id"), "cell_id", F.col("condition").alias("cluster_id")))
    table = v.spark.createDataFrame([("r0",), ("r1",), ("r2",)], "round_id string")
    return rounds.refreshed(table, labels, v.obs.where("cell_id % 3 = 0"))[1].select("round_id", "cluster_id", "n_cells", "cluster_rank")


_MODULES = """--with mu AS (SELECT gene_id, sum(value) / (SELECT count(*) FROM obs) AS m FROM counts GROUP BY 1), b AS (SELECT gene_id, ntile(5) OVER (ORDER BY m, gene_id) AS bin FROM mu),
s AS (SELECT DISTINCT p_type AS source, p_brand AS gene_id FROM part WHERE p_size <= 2), mine AS (SELECT source, gene_id, bin FROM s JOIN b USING (gene_id)), u AS (SELECT DISTINCT source, bin FROM mine),
c AS (SELECT source, gene_id, row_number() OVER (PARTITION BY source, bin ORDER BY md5('0|' || gene_id), gene_id) AS r FROM u JOIN b USING (bin) WHERE (source, gene_id) NOT IN (SELECT source, gene_id FROM mine)),
g AS (SELECT source, gene_id, 1 AS i FROM mine UNION ALL SELECT source, gene_id, 0 FROM c WHERE r <= 4), z AS (SELECT source, sum(i) AS a, sum(1 - i) AS k FROM g GROUP BY 1),
x AS (SELECT cell_id, source, sum(CASE WHEN i = 1 THEN value ELSE 0 END) AS x, sum(CASE WHEN i = 0 THEN value ELSE 0 END) AS y FROM counts JOIN g USING (gene_id) GROUP BY 1, 2)
SELECT cell_id, source, round(coalesce(x, 0) / a - CASE WHEN k > 0 THEN coalesce(y, 0) / k ELSE 0 END, 6) AS score FROM (SELECT cell_id, source FROM obs, (SELECT DISTINCT source FROM s)) LEFT JOIN x USING (cell_id, source) JOIN z USING (source)"""


@query("module_scores", _MODULES)
def module_scores(v: Views):
    modules = v.table("part").where("p_size <= 2").select(F.col("p_type").alias("source"), F.col("p_brand").alias("target"))
    return enrichment.module_scores(v.counts, v.obs, modules).withColumn("score", F.round("score", 6))


_TESTED, _SCORED = ORACLES["wilcoxon_levels"].split("\nSELECT cluster_id, gene_id, round(z, 5) AS score, round(")
_RECEIVER = f"""{_TESTED}, pv AS (SELECT cluster_id, gene_id, {_SCORED.split(", 5) AS pval")[0]} AS pval, ka / n1 AS pct_a, kb / n2 AS pct_b FROM w),
o AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY pval, gene_id) AS rn, count(*) OVER (PARTITION BY cluster_id) AS m FROM pv),
f AS (SELECT *, least(1.0::DOUBLE, min(pval * m / rn) OVER (PARTITION BY cluster_id ORDER BY rn DESC)) AS padj FROM o) SELECT cluster_id, gene_id, round(padj, 5) AS padj FROM f WHERE padj <= 0.9 AND abs(pct_a - pct_b) >= 0.02"""


@query("receiver_genes")
def receiver_genes(v: Views):
    from ..operators import tasks

    return tasks.receiver_genes(ranktests.wilcoxon_levels(v.counts, v.obs, "cluster_id", "condition", "ASIA", "EUROPE"), "cluster_id", 0.9, 0.02).select("cluster_id", "gene_id", F.round("padj", 5).alias("padj"))


ORACLES["receiver_genes"] = _RECEIVER

_COMPACT = _COS.replace("--with", "", 1)
ORACLES["compacted_clusters"] = sql("SELECT 1").split("\nSELECT 1")[0].replace("WITH ", "WITH RECURSIVE ", 1) + f",{_COMPACT}, t AS (SELECT least(0.98, greatest(-0.5, quantile_cont(cosine, 0.9)))::DOUBLE AS threshold FROM c), pass AS (SELECT a, b FROM c, t WHERE cosine >= threshold), nn AS (SELECT cluster_id AS cluster, count(*) AS n_cells FROM obs GROUP BY 1)" + _GROUPS.format(edges="pass")
ORACLES["compacted_round"] = sql("SELECT 1").split("\nSELECT 1")[0].replace("WITH ", "WITH RECURSIVE ", 1) + "," + _VIEWS.replace("--with", "", 1) + ", pass AS (SELECT a, b FROM r WHERE pass_pathway AND pass_regulator AND n_passed >= 3)" + _GROUPS.format(edges="pass")

_SEEDS = "m AS (SELECT cell_id, label, md5('0|' || cell_id) AS h FROM emb), sr AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, cell_id) AS k, count(*) OVER (PARTITION BY label) AS n FROM m), f AS (SELECT cell_id FROM sr WHERE k = 1 AND n >= 20), g AS (SELECT cell_id FROM sr WHERE cell_id NOT IN (SELECT cell_id FROM f) ORDER BY h, cell_id LIMIT 5), seeds AS (SELECT * FROM f UNION ALL SELECT * FROM g)"
ORACLES["neighbourhood_abundance"] = sql(f"--with {_SEEDS}, {_KNN.replace('--with', '', 1).replace('WHERE cell_id % 50 = 0', 'WHERE cell_id IN (FROM seeds)')}, mem AS (SELECT query AS seed, neighbour AS cell_id FROM r WHERE place <= 31), tot AS (SELECT sample, min(condition) AS condition, count(*) AS total FROM emb GROUP BY 1), k AS (SELECT seed, sample, count(*) AS n FROM mem JOIN emb USING (cell_id) GROUP BY 1, 2), gr AS (SELECT seed, sample, condition, coalesce(n, 0) AS n, total FROM (SELECT DISTINCT seed FROM mem) CROSS JOIN tot LEFT JOIN k USING (seed, sample)), ok AS (SELECT seed FROM (SELECT seed, condition, count(*) FILTER (n > 0) AS k FROM gr GROUP BY 1, 2) WHERE k >= 1 GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT condition) FROM tot)) SELECT seed, sample, condition, n, total FROM gr WHERE seed IN (FROM ok)")
