"""Signals by condition, route families, candidate events, metabolite events and ligand links over the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import signals
from .network_queries import _LR, events_of, pairs_of
from .registry import query
from .views import Views

_BY = """--with lr AS (SELECT unnest(['Brand#11', 'Brand#12', 'Brand#23']) AS ligand, unnest(['Brand#21', 'Brand#22', 'Brand#14']) AS receptor),
c AS (SELECT cell_id, cluster_id, sample_id, {context} AS context, {level} AS level FROM obs), n AS (SELECT context, level, cluster_id, count(*) AS n FROM c GROUP BY 1, 2, 3),
m AS (SELECT context, level, cluster_id, gene_id, sum(value) / n AS mean, count(*)::DOUBLE / n AS fraction FROM counts JOIN c USING (cell_id) JOIN n USING (context, level, cluster_id) GROUP BY 1, 2, 3, 4, n),
w AS (SELECT *, mean / sum(mean) OVER (PARTITION BY context, level, gene_id) AS weight FROM m),
mu AS (SELECT context, level, sum(value) / (max(k) * count(DISTINCT gene_id)) AS mu FROM counts JOIN c USING (cell_id) JOIN (SELECT context, level, count(*) AS k FROM c GROUP BY 1, 2) USING (context, level) GROUP BY 1, 2),
ev AS (SELECT a.context, a.level, a.cluster_id AS source, b.cluster_id AS target, ligand, receptor, (a.mean + b.mean) / 2 AS lr_means, a.weight * b.weight AS spec_weight, sqrt(a.mean * b.mean) / (sqrt(a.mean * b.mean) + mu) AS lrscore
  FROM lr JOIN w a ON a.gene_id = ligand AND a.fraction >= 0.1 JOIN w b ON b.gene_id = receptor AND b.fraction >= 0.1 AND b.context = a.context AND b.level = a.level JOIN mu ON mu.context = a.context AND mu.level = a.level)
SELECT context, level, source, target, ligand, receptor, round(lr_means, 6) AS lr_means, round(spec_weight, 6) AS spec_weight, round(lrscore, 6) AS lrscore FROM ev"""


def _rounded(rows):
    return rows.select("context", "level", "source", "target", "ligand", "receptor", *(F.round(c, 6).alias(c) for c in ("lr_means", "spec_weight", "lrscore")))


@query("signals_by_condition", _BY.format(context="'all'", level="condition"))
def signals_by_condition(v: Views):
    return _rounded(signals.scores_by_condition(v.counts, v.obs, "cluster_id", pairs_of(v), "condition"))


@query("signals_within_context", _BY.format(context="'condition=' || condition", level="sample_id"))
def signals_within_context(v: Views):
    return _rounded(signals.scores_by_condition(v.counts, v.obs, "cluster_id", pairs_of(v), "sample_id@condition"))


_PAIRS = "--with g AS (SELECT DISTINCT p_brand, ['TLR4', 'ITGA5', 'MET', 'NOTCH1', 'LRP1', 'KLRB1', 'EPHA2', 'CCR5'][1 + p_size % 8] AS receptor, ['HMGB1', 'EFNB1', 'ADAM17', 'B2M', 'CXCL8'][1 + p_size % 5] AS ligand FROM part)"


@query("route_families", _PAIRS + """ SELECT ligand, receptor, CASE WHEN ligand = 'CXCL8' AND receptor = 'CCR5' THEN 'CHEMOKINE' WHEN receptor = 'TLR4' OR ligand = 'HMGB1' THEN 'Innate sensing / complement' WHEN receptor = 'ITGA5' THEN 'ECM / adhesion'
WHEN receptor = 'MET' THEN 'Growth factor / receptor handling' WHEN receptor = 'NOTCH1' THEN 'Notch / juxtacrine' WHEN receptor = 'LRP1' THEN 'Scavenger / metabolic handling' WHEN receptor = 'KLRB1' OR ligand = 'B2M' THEN 'Immune recognition'
WHEN receptor = 'EPHA2' OR ligand = 'EFNB1' THEN 'Guidance / interface' WHEN ligand = 'ADAM17' THEN 'Protease / cytokine interface' ELSE 'Other' END AS route_family, count(*) AS n FROM g GROUP BY 1, 2""")
def route_families(v: Views):
    size = F.col("p_size")
    receptor = F.get(F.array(*(F.lit(x) for x in ("TLR4", "ITGA5", "MET", "NOTCH1", "LRP1", "KLRB1", "EPHA2", "CCR5"))), (size % 8).cast("int"))
    ligand = F.get(F.array(*(F.lit(x) for x in ("HMGB1", "EFNB1", "ADAM17", "B2M", "CXCL8"))), (size % 5).cast("int"))
    pairs = v.table("part").select("p_brand", receptor.alias("receptor"), ligand.alias("ligand")).distinct()
    lookup = v.spark.createDataFrame([("cxcl8", "ccr-5", "CHEMOKINE", signals.SECRETED)], "ligand string, receptor string, pathway string, annotation string")
    return signals.routed(pairs, lookup).groupBy("ligand", "receptor", "route_family").agg(F.count("*").alias("n"))


@query("cross_tissue_secreted", _LR + " SELECT source, target, ligand, receptor FROM ev WHERE source IN ('BUILDING', 'MACHINERY') AND target = 'FURNITURE' AND ligand IN ('Brand#11', 'Brand#23')")
def cross_tissue_secreted(v: Views):
    levels = v.spark.createDataFrame([("BUILDING", "a"), ("MACHINERY", "a"), ("FURNITURE", "b"), ("AUTOMOBILE", "")], "cluster string, level string")
    lookup = v.spark.createDataFrame([("Brand#11", "BRAND 21", "x", signals.SECRETED), ("brand23", "brand14", "y", signals.SECRETED), ("Brand#12", "Brand#22", "z", "ECM-Receptor")], "ligand string, receptor string, pathway string, annotation string")
    return signals.cross_scope(events_of(v), levels, ["a", ""], ["b"], "secreted", lookup).select("source", "target", "ligand", "receptor")


@query("candidate_events", _LR + ", d AS (SELECT cluster_id AS label, row_number() OVER (ORDER BY cluster_id) - 1 AS cluster FROM (SELECT DISTINCT cluster_id FROM obs)), k AS (SELECT s.cluster AS source_token, t.cluster AS target_token, ligand, receptor, source || ' -> ' || target AS branch_pair, lrscore FROM ev JOIN d s ON s.label = source JOIN d t ON t.label = target WHERE ligand IN ('Brand#11', 'Brand#12')) SELECT source_token, target_token, ligand, receptor, branch_pair, round(lrscore, 6) AS lrscore FROM k ORDER BY k.lrscore DESC, source_token, target_token, ligand, receptor LIMIT 20")
def candidate_events(v: Views):
    from pyspark.sql import Window

    display = v.obs.select(F.col("cluster_id").alias("label")).distinct().withColumn("cluster", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("label")).cast("long") - 1)
    found = signals.normalise_events(events_of(v).drop("lr_means", "expr_prod", "spec_weight"), display)
    picked = signals.candidate_events(found, {"ligand": ["Brand#11", "Brand#12"], "receptor": []}, limit=20)
    return picked.select("source_token", "target_token", "ligand", "receptor", "branch_pair", F.round("lrscore", 6).alias("lrscore"))


@query("annotation_summary", "SELECT c_mktsegment AS focus, coalesce(CASE WHEN c_nationkey % 3 > 0 THEN 'class ' || (c_nationkey % 3) END, 'Unannotated') AS annotation, count(*) AS n_events, round(avg(c_acctbal), 6) AS mean_score FROM customer GROUP BY 1, 2")
def annotation_summary(v: Views):
    kind = F.when(F.col("c_nationkey") % 3 > 0, F.concat(F.lit("class "), (F.col("c_nationkey") % 3).cast("string")))
    rows = v.table("customer").select(F.col("c_mktsegment").alias("focus"), kind.alias("annotation"), "c_acctbal")
    return signals.annotation_summary(rows, "annotation", "c_acctbal", "focus").withColumn("mean_score", F.round("mean_score", 6))


_MET = """--with e AS (SELECT unnest([1, 2, 3, 4])::BIGINT AS event, unnest(['BUILDING', 'MACHINERY', 'FURNITURE', 'BUILDING']) AS source, unnest(['FURNITURE', 'BUILDING', 'AUTOMOBILE', 'MACHINERY']) AS target, unnest(['M1', 'M2', 'M3', 'M4']) AS metabolite, unnest(['Brand#21', 'Brand#22', 'absent', 'Brand#24']) AS sensor, unnest(['Brand#11;Brand#12', 'Brand#13; nowhere', 'Brand#14', 'nowhere']) AS genes),
b AS (SELECT e.*, sample_id FROM e, (SELECT DISTINCT sample_id FROM obs)), nc AS (SELECT sample_id, cluster_id, count(*) AS n FROM obs GROUP BY 1, 2),
p AS (SELECT sample_id, cluster_id, cell_id, gene_id, value FROM counts JOIN obs USING (cell_id)),
l AS (SELECT event, source, trim(unnest(string_split(genes, ';'))) AS gene_id FROM e), d AS (SELECT * FROM l WHERE gene_id IN (SELECT gene_id FROM var)),
q AS (SELECT event, count(*) AS n_genes, count(*) FILTER (gene_id IN (SELECT gene_id FROM var)) AS n_detected FROM l GROUP BY 1),
s AS (SELECT sample_id, event, sum(value) AS s, count(DISTINCT cell_id) AS k FROM p JOIN d ON d.gene_id = p.gene_id AND d.source = p.cluster_id GROUP BY 1, 2),
t AS (SELECT sample_id, cluster_id AS target, gene_id AS sensor, sum(value) AS rs, count(*) AS rk FROM p GROUP BY 1, 2, 3),
x AS (SELECT b.event, b.sample_id, coalesce(x.n, 0) AS sender_cells, coalesce(y.n, 0) AS receiver_cells, n_genes, n_detected, {sender} coalesce(rs, 0) / y.n AS receiver_score, b.sensor IN (SELECT gene_id FROM var) AS known
  FROM b LEFT JOIN nc x ON x.sample_id = b.sample_id AND x.cluster_id = b.source LEFT JOIN nc y ON y.sample_id = b.sample_id AND y.cluster_id = b.target JOIN q ON q.event = b.event LEFT JOIN s ON s.sample_id = b.sample_id AND s.event = b.event LEFT JOIN t ON t.sample_id = b.sample_id AND t.target = b.target AND t.sensor = b.sensor {more}),
z AS (SELECT *, CASE WHEN sender_cells < 9 THEN 'too_few_sender_cells' WHEN receiver_cells < 9 THEN 'too_few_receiver_cells' WHEN {first} WHEN NOT known THEN 'sensor_gene_absent' END AS missing_reason FROM x)
"""


def _events(v: Views):
    return v.spark.createDataFrame([(1, "BUILDING", "FURNITURE", "M1", "Brand#21", "Brand#11;Brand#12"), (2, "MACHINERY", "BUILDING", "M2", "Brand#22", "Brand#13; nowhere"), (3, "FURNITURE", "AUTOMOBILE", "M3", "absent", "Brand#14"), (4, "BUILDING", "MACHINERY", "M4", "Brand#24", "nowhere")], "event long, source string, target string, metabolite string, sensor string, genes string")


@query("metabolite_rescore", _MET.format(sender="s.s / (x.n * n_detected) AS sender_score, s.k::DOUBLE / x.n AS sender_share,", more="", first="n_detected = 0 THEN 'no_associated_genes_detected'") + "SELECT event, sample_id, sender_cells, receiver_cells, n_genes, n_detected, missing_reason, round(CASE WHEN missing_reason IS NULL THEN sender_share END, 6) AS sender_share, round(CASE WHEN missing_reason IS NULL THEN ln(1 + sqrt(sender_score * receiver_score)) END, 6) AS score FROM z")
def metabolite_rescore(v: Views):
    found = signals.metabolite_rescore(v.counts, v.obs, v.var, _events(v), "sample_id", "cluster_id", least_senders=9, least_receivers=9)
    share = F.when(F.col("missing_reason").isNull(), F.col("sender_share"))
    return found.select("event", "sample_id", "sender_cells", "receiver_cells", "n_genes", "n_detected", "missing_reason", F.round(share, 6).alias("sender_share"), F.round("score", 6).alias("score"))


@query("metabolite_sensor_rescore", _MET.format(sender="CASE WHEN b.metabolite != 'M4' THEN m.score END AS sender_score,", more="LEFT JOIN (SELECT sample_id, cluster_id, avg(value) AS score FROM p WHERE gene_id = 'Brand#11' GROUP BY 1, 2) m ON m.sample_id = b.sample_id AND m.cluster_id = b.source", first="sender_score IS NULL THEN 'metabolite_not_estimated'") + "SELECT event, sample_id, missing_reason, round(CASE WHEN missing_reason IS NULL THEN ln(1 + sqrt(sender_score * receiver_score)) END, 6) AS score FROM z")
def metabolite_sensor_rescore(v: Views):
    one = v.counts.where("gene_id = 'Brand#11'").join(v.obs, "cell_id").groupBy("sample_id", "cluster_id").agg(F.avg("value").alias("score"))
    estimates = one.crossJoin(v.spark.createDataFrame([("M1",), ("M2",), ("M3",)], "metabolite string")).withColumn("share", F.lit(1.0))
    found = signals.metabolite_rescore(v.counts, v.obs, v.var, _events(v), "sample_id", "cluster_id", method=signals.SENSOR, estimates=estimates, least_senders=9, least_receivers=9)
    return found.select("event", "sample_id", "missing_reason", F.round("score", 6).alias("score"))


@query("ligand_links", """--with t AS (SELECT cluster_id AS ligand, gene_id, sum(value) AS score FROM pb GROUP BY 1, 2), a AS (SELECT ligand, corr(score, (gene_id IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#14'))::INTEGER) AS activity FROM t GROUP BY 1), b AS (SELECT ligand, row_number() OVER (ORDER BY round(activity, 9) DESC, ligand) AS ligand_rank FROM a)
SELECT * FROM (SELECT ligand, gene_id, round(score, 6) AS score, ligand_rank, row_number() OVER (PARTITION BY ligand ORDER BY round(t.score, 9) DESC, gene_id) AS link_rank FROM t JOIN b USING (ligand) WHERE ligand_rank <= 3 AND gene_id IN ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#14')) WHERE link_rank <= 2""")
def ligand_links(v: Views):
    targets = v.pb.groupBy(F.col("cluster_id").alias("ligand"), "gene_id").agg(F.sum("value").alias("score"))
    geneset = v.var.where("gene_id in ('Brand#11', 'Brand#12', 'Brand#13', 'Brand#14')")
    from ..operators.communication import ligand_activity

    return signals.ligand_links(targets, ligand_activity(targets, geneset), geneset, 3, 2).withColumn("score", F.round("score", 6))


@query("sender_focused_ligands", "--with n AS (SELECT cluster_id, count(*) AS n FROM obs GROUP BY 1), x AS (SELECT cluster_id, gene_id FROM counts JOIN obs USING (cell_id) JOIN n USING (cluster_id) GROUP BY 1, 2, n HAVING count(*)::DOUBLE / n >= 0.3), lr AS (SELECT unnest(['Brand#11', 'Brand#12', 'Brand#23']) AS ligand, unnest(['Brand#21', 'Brand#22', 'Brand#14']) AS receptor), l AS (SELECT DISTINCT ligand FROM lr WHERE ligand IN (SELECT gene_id FROM x WHERE cluster_id = 'BUILDING') AND receptor IN (SELECT gene_id FROM x WHERE cluster_id = 'FURNITURE')), t AS (SELECT a.gene_id AS ligand, b.gene_id, sum(a.value * b.value) AS score FROM pb a JOIN pb b USING (sample_id, cluster_id) WHERE a.gene_id IN (FROM l) GROUP BY 1, 2) SELECT ligand, round(corr(score, (gene_id IN ('Brand#11', 'Brand#12', 'Brand#13'))::INTEGER), 6) AS activity FROM t GROUP BY 1")
def sender_focused_ligands(v: Views):
    a = v.pb.select("sample_id", "cluster_id", F.col("gene_id").alias("ligand"), F.col("value").alias("x"))
    targets = a.join(pairs_of(v).select("ligand").distinct(), "ligand", "left_semi").join(v.pb, ["sample_id", "cluster_id"]).groupBy("ligand", "gene_id").agg(F.sum(F.col("x") * F.col("value")).alias("score"))
    geneset = v.var.where("gene_id in ('Brand#11', 'Brand#12', 'Brand#13')")
    activity, _ = signals.sender_focused(v.counts, v.obs, "cluster_id", "BUILDING", "FURNITURE", pairs_of(v), targets, geneset, least_share=0.3)
    return activity.withColumn("activity", F.round("activity", 6))
