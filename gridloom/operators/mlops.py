"""Operators that the ML library provides."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.lineage import materialise


def logistic_coefficients(layer: DataFrame, obs: DataFrame, group: str, a: str, b: str, penalty: float = 0.01) -> DataFrame:
    """Genes by their coefficient in an L2 logistic regression of a against b, on sparse vectors by the genes' numbers.
    Cells without a value of any gene take no part. The coefficients, one a gene, pass through the driver."""
    genes = materialise(layer.select("gene_id").distinct().withColumn("_i", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("gene_id")) - 1))  # genes, not cells
    n = genes.count()
    cells = obs.where(F.col(group).isin(a, b)).select("cell_id", (F.col(group) == a).cast("double").alias("label"))
    held = layer.join(cells, "cell_id").join(F.broadcast(genes), "gene_id").groupBy("cell_id", "label").agg(F.sort_array(F.collect_list(F.struct("_i", F.col("value").cast("double").alias("x")))).alias("_v"))
    sparse = F.udf(lambda at, x: Vectors.sparse(n, at, x), VectorUDT())
    model = LogisticRegression(regParam=penalty, standardization=True, maxIter=50).fit(held.select("label", sparse("_v._i", "_v.x").alias("features")))
    found = layer.sparkSession.createDataFrame([(k, float(x)) for k, x in enumerate(model.coefficients)], "_i int, coefficient double")
    return genes.join(F.broadcast(found), "_i").select("gene_id", "coefficient")


def principal_components(cells: DataFrame, k: int, vec: str = "vec") -> DataFrame:
    """Scores of the first k components of centred vectors."""
    from pyspark.ml.feature import StandardScaler

    rows = cells.select("cell_id", array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
    centred = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(rows).transform(rows)
    return PCA(k=k, inputCol="_c", outputCol="_p").fit(centred).transform(centred).select("cell_id", vector_to_array("_p").alias("scores"))
