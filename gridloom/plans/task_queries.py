"""Contrast tasks, aliases, library prevalence, paired effects and per-cell recovery areas over the views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import conditions, enrichment, qc, tasks
from .network_queries import _NET, net_of, rescored
from .qc_queries import _PROBA, probabilities
from .registry import query
from .views import Views


@query("contrast_tasks", "--with l AS (SELECT DISTINCT condition FROM obs), p AS (SELECT a.condition AS a, b.condition AS b FROM l a JOIN l b ON a.condition < b.condition), n AS (SELECT cluster_id, condition, count(*) AS n FROM obs GROUP BY 1, 2), g AS (SELECT cluster_id, p.a, p.b, coalesce(x.n, 0) AS n_a, coalesce(y.n, 0) AS n_b FROM (SELECT DISTINCT cluster_id FROM obs) CROSS JOIN p LEFT JOIN n x USING (cluster_id) LEFT JOIN n y USING (cluster_id) WHERE x.condition = p.a AND y.condition = p.b) SELECT cluster_id, a, b, n_a, n_b, CASE WHEN n_a < 55 OR n_b < 55 THEN 'too_few_cells' END AS skip_reason FROM g")
def contrast_tasks(v: Views):
    return tasks.contrast_tasks(v.obs, "cluster_id", "condition", conditions.all_pairs(v.obs, "condition"), 55)


@query("standard_columns", "SELECT c_custkey AS key, c_mktsegment AS cluster, c_acctbal AS effect FROM customer")
def standard_columns(v: Views):
    return tasks.standardise(v.table("customer"), {"key": ("id", "c_custkey"), "cluster": ("cluster", "c_mktsegment"), "effect": ("log2fc", "c_acctbal")})


@query("supervision_labels", _PROBA + "SELECT cell_id, CASE WHEN margin >= 0.3 THEN label ELSE 'Unknown' END AS label FROM e")
def supervision_labels(v: Views):
    found = qc.confidence(probabilities(v), entropy_abs=99.0, entropy_quantile=0.5, min_margin=0.3)
    return tasks.supervision(found, "label", "confident").select("cell_id", "label")


@query("library_prevalence", "--with n AS (SELECT cluster_id, count(*) AS n FROM libs GROUP BY 1), k AS (SELECT cluster_id, gene_id, count(*) AS k FROM pb WHERE value > 150 GROUP BY 1, 2) SELECT cluster_id AS level, gene_id, round(k::DOUBLE / n, 6) AS share FROM k JOIN n USING (cluster_id) WHERE k::DOUBLE / n >= 0.8")
def library_prevalence(v: Views):
    name = F.concat_ws("|", "sample_id", "cluster_id").alias("library")
    found = tasks.library_prevalence(v.libs.select(name, F.col("cluster_id").alias("level")), v.pb.where("value > 150").select(name, "gene_id", "value"), "level", 0.8)
    return found.withColumn("share", F.round("share", 6))


@query("paired_effects")
def paired_effects(v: Views):
    """Exact tests of a few samples."""
    levels = v.obs.select("sample_id", "condition").distinct()
    return tasks.paired_effects(rescored(v).join(F.broadcast(levels), "sample_id"), ["event"], "condition", "score", "ASIA", "EUROPE")


@query("aucell_by_cell", _NET + ", r AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY value DESC, gene_id) AS rk FROM counts), k AS (SELECT source, least(count(*), 5) AS k FROM net GROUP BY 1), a AS (SELECT cell_id, source, sum(5 - rk + 1) AS area FROM r JOIN net ON gene_id = target WHERE rk <= 5 GROUP BY 1, 2) SELECT cell_id, source, round(area / (k * 5 - k * (k - 1) / 2), 6) AS score FROM a JOIN k USING (source)")
def aucell_by_cell(v: Views):
    return enrichment.aucell(v.counts, net_of(v), "cell_id", 5).withColumn("score", F.round("score", 6))


@query("event_matrix", "SELECT gene_id, count(*) AS n_cells, sum(value) AS total FROM evt GROUP BY 1")
def event_matrix(v: Views):
    return v.evt.groupBy("gene_id").agg(F.count("*").alias("n_cells"), F.sum("value").alias("total"))
