"""Cells, genes and counts as views of the star-schema tables, the same for Spark and for DuckDB."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: DuckDB text of the views.
CTES = """obs AS (SELECT c_custkey AS cell_id, n_name AS sample_id, r_name AS condition, c_mktsegment AS cluster_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
var AS (SELECT p_brand AS gene_id, min(p_type) AS gene_type FROM part GROUP BY 1),
counts AS (SELECT o_custkey AS cell_id, p_brand AS gene_id, sum(l_quantity) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
counts_cb AS (SELECT o_custkey AS cell_id, p_brand AS gene_id, sum(l_quantity * (1 - l_discount)) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
emb AS (SELECT vec_id AS cell_id, label, vec_id % 12 AS sample, (vec_id % 12) % 2 AS condition, embedding AS vec FROM embeddings),
evt AS (SELECT user_id AS cell_id, event_type AS gene_id, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY 1, 2),
cells AS (SELECT obs.*, coalesce(t, 0) AS total_counts, coalesce(g, 0) AS n_genes, 100.0::DOUBLE * coalesce(m, 0) / greatest(coalesce(t, 0), 1) AS pct_mt
  FROM obs LEFT JOIN (SELECT cell_id, sum(value) t, count(*) g, sum(CASE WHEN gene_id LIKE 'Brand#1%' THEN value END) m FROM counts GROUP BY 1) USING (cell_id)),
pb AS (SELECT sample_id, cluster_id, gene_id, sum(value) AS value FROM counts JOIN obs USING (cell_id) GROUP BY ALL),
libs AS (SELECT sample_id, cluster_id, min(condition) AS condition, count(*) AS n_cells FROM obs GROUP BY 1, 2)"""


def sql(body: str) -> str:
    return f"WITH {CTES}{',' if body.lstrip().startswith('--with') else ''}\n{body.replace('--with', '', 1)}"


def r6(value: Column | str, name: str) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, 6).alias(name)


class Views:
    """The views of one data folder; nothing is read before a query asks for it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def obs(self) -> DataFrame:
        customer, nation, region = (self.table(t) for t in ("customer", "nation", "region"))
        place = nation.join(region, nation.n_regionkey == region.r_regionkey)
        return customer.join(F.broadcast(place), customer.c_nationkey == place.n_nationkey).select(F.col("c_custkey").alias("cell_id"), F.col("n_name").alias("sample_id"), F.col("r_name").alias("condition"), F.col("c_mktsegment").alias("cluster_id"))

    @cached_property
    def var(self) -> DataFrame:
        return self.table("part").groupBy(F.col("p_brand").alias("gene_id")).agg(F.min("p_type").alias("gene_type"))

    def _counts(self, value: Column) -> DataFrame:
        line, orders, part = self.table("lineitem"), self.table("orders"), self.table("part")
        met = line.join(orders, line.l_orderkey == orders.o_orderkey).join(part, line.l_partkey == part.p_partkey)
        return met.groupBy(F.col("o_custkey").alias("cell_id"), F.col("p_brand").alias("gene_id")).agg(F.sum(value).alias("value"))

    @cached_property
    def counts(self) -> DataFrame:
        return self._counts(F.col("l_quantity"))

    @cached_property
    def counts_cb(self) -> DataFrame:
        return self._counts(F.col("l_quantity") * (1 - F.col("l_discount")))

    @cached_property
    def emb(self) -> DataFrame:
        v = F.col("vec_id")
        return self.table("embeddings").select(v.alias("cell_id"), "label", (v % 12).alias("sample"), ((v % 12) % 2).alias("condition"), F.col("embedding").alias("vec"))

    @cached_property
    def evt(self) -> DataFrame:
        return self.table("events").groupBy(F.col("user_id").alias("cell_id"), F.col("event_type").alias("gene_id")).agg(F.count("*").cast("double").alias("value"))

    @cached_property
    def cells(self) -> DataFrame:
        from ..operators import qc

        return qc.cell_metrics(self.counts, self.obs, {"mt": F.col("gene_id").startswith("Brand#1")}, ("sample_id", "condition", "cluster_id"))

    @cached_property
    def pb(self) -> DataFrame:
        return self.counts.join(self.obs, "cell_id").groupBy("sample_id", "cluster_id", "gene_id").agg(F.sum("value").alias("value"))

    @cached_property
    def libs(self) -> DataFrame:
        return self.obs.groupBy("sample_id", "cluster_id").agg(F.min("condition").alias("condition"), F.count("*").alias("n_cells"))
