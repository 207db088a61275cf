"""Kernels over the views. Exact tests, iterative fits and permutations have no SQL text; unit tests hold them
against enumeration and closed forms. What SQL can express has one."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import kernels, neighbourhoods, pseudobulk
from .network_queries import matrix_of, net_of
from .registry import query
from .views import Views


def shares_of(v: Views):
    levels = v.obs.select("sample_id", "condition").distinct()
    return pseudobulk.crosstab(v.obs, "sample_id", "cluster_id").join(F.broadcast(levels), "sample_id")


@query("mwu_composition")
def mwu_composition(v: Views):
    """Exact for few samples, so without SQL."""
    return kernels.mann_whitney_by(shares_of(v), ["cluster_id"], "condition", "share", "ASIA", "EUROPE")


@query("glm_binomial")
def glm_binomial(v: Views):
    """Iterative fit."""
    rows = shares_of(v).withColumn("total", F.sum("n").over(Window.partitionBy("sample_id")))
    return kernels.composition_glm(rows.select(F.col("cluster_id").alias("cluster"), "condition", "n", "total"), "AFRICA")


@query("size_factors", "--with p AS (SELECT sample_id || '|' || cluster_id AS library, gene_id, value FROM pb), r AS (SELECT gene_id, sum(ln(value)) / (SELECT count(DISTINCT library) FROM p) AS ref FROM p GROUP BY 1), f AS (SELECT library, median(ln(value) - ref) AS f FROM p JOIN r USING (gene_id) GROUP BY 1) SELECT library, round(exp(f - (SELECT avg(f) FROM f)), 6) AS size_factor FROM f")
def size_factors(v: Views):
    return kernels.size_factors(v.pb.select(F.concat_ws("|", "sample_id", "cluster_id").alias("library"), "gene_id", "value")).withColumn("size_factor", F.round("size_factor", 6))


@query("pseudobulk_nb")
def pseudobulk_nb(v: Views):
    """Iterative fit."""
    libs = v.libs.select(F.concat_ws("|", "sample_id", "cluster_id").alias("library"), "condition", "cluster_id")
    counts = v.pb.select(F.concat_ws("|", "sample_id", "cluster_id").alias("library"), "gene_id", "value")
    return kernels.pseudobulk_nb(libs, counts, "condition", "ASIA", "EUROPE", ("cluster_id",), 8)


@query("gsea_permutation")
def gsea_permutation(v: Views):
    """Seeded permutations."""
    stats = matrix_of(v).select("cluster_id", "gene_id", (F.col("value") - F.avg("value").over(Window.partitionBy("cluster_id"))).alias("stat"))
    return kernels.gsea(stats, net_of(v), "cluster_id", 100)


_KNN = "--with q AS (SELECT cell_id AS query, vec AS qv FROM emb WHERE cell_id % 50 = 0), d AS (SELECT query, cell_id AS neighbour, sqrt(list_sum(list_transform(list_zip(qv, vec), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE)))) AS distance FROM q, emb), r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, neighbour) AS place FROM d)"


@query("nearest_neighbours", _KNN + " SELECT query, neighbour, place, round(distance, 6) AS distance FROM r WHERE place <= 10")
def nearest_neighbours(v: Views):
    return kernels.nearest(v.emb, v.emb.where("cell_id % 50 = 0"), 10).select("query", "neighbour", "place", F.round("distance", 6).alias("distance"))


_SIL = """--with d AS (SELECT a.cell_id, a.label AS own, b.label AS other, sqrt(list_sum(list_transform(list_zip(a.vec, b.vec), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE)))) AS d FROM emb a, emb b),
s AS (SELECT cell_id, own, other, sum(d) AS s, count(*) AS n FROM d GROUP BY ALL), m AS (SELECT cell_id, own AS label, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN own != other THEN s / n END) AS b FROM s GROUP BY 1, 2),
sil AS (SELECT cell_id, label, CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM m)"""


@query("cell_silhouette", _SIL + " SELECT cell_id, label, round(silhouette, 6) AS silhouette FROM sil")
def cell_silhouette(v: Views):
    """Blocked distances of all cells against all cells."""
    return kernels.silhouette(v.emb, v.emb, "label").select("cell_id", F.col("label").cast("int").alias("label"), F.round("silhouette", 6).alias("silhouette"))


@query("cell_silhouette_summary", _SIL + " SELECT count(*) AS n, round(avg(silhouette), 6) AS mean, round(median(silhouette), 6) AS median, round(quantile_cont(silhouette, 0.1), 6) AS p10, round(quantile_cont(silhouette, 0.9), 6) AS p90 FROM sil")
def cell_silhouette_summary(v: Views):
    """Of all cells, see above."""
    found = kernels.silhouette_summary(kernels.silhouette(v.emb, v.emb, "label"))
    return found.select("n", *(F.round(c, 6).alias(c) for c in ("mean", "median", "p10", "p90")))


def members_of(v: Views):
    picked = neighbourhoods.seeds(v.emb, "label", 5, 20)
    return neighbourhoods.neighbourhoods(v.emb, picked, 30)


@query("neighbourhood_seeds", "--with m AS (SELECT cell_id, label, md5('0|' || cell_id) AS h FROM emb), r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, cell_id) AS k, count(*) OVER (PARTITION BY label) AS n FROM m), f AS (SELECT cell_id, label FROM r WHERE k = 1 AND n >= 20), g AS (SELECT cell_id, label FROM r WHERE cell_id NOT IN (SELECT cell_id FROM f) ORDER BY h, cell_id LIMIT 5) SELECT * FROM f UNION ALL SELECT * FROM g")
def neighbourhood_seeds(v: Views):
    return neighbourhoods.seeds(v.emb, "label", 5, 20).select("cell_id", "label")


@query("neighbourhood_abundance")
def neighbourhood_abundance(v: Views):
    """Its SQL stands with the design queries."""
    return neighbourhoods.abundance(members_of(v), v.emb, "sample", "condition", 1).select("seed", "sample", "condition", "n", "total")


@query("neighbourhood_differential")
def neighbourhood_differential(v: Views):
    """Iterative fits."""
    members = members_of(v)
    radius = members.groupBy("seed").agg(F.median("distance").alias("radius"))
    return neighbourhoods.differential(neighbourhoods.abundance(members, v.emb, "sample", "condition", 1), radius, "0")


@query("cell_calling")
def cell_calling(v: Views):
    """Mixture and knee."""
    return kernels.call_cells(v.cells.select("sample_id", F.col("total_counts").alias("total")))


@query("logistic_ranking")
def logistic_ranking(v: Views):
    """Coefficients of a logistic regression of one cluster against another, by the ML library."""
    from ..operators.mlops import logistic_coefficients

    return logistic_coefficients(v.counts, v.obs, "cluster_id", "BUILDING", "FURNITURE")


@query("pca")
def pca(v: Views):
    """Principal components by the ML library."""
    from ..operators.mlops import principal_components

    return principal_components(v.emb, 5)
