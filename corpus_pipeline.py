"""A corpus from raw documents to batches: five stages, each written and read again by the next.

Every stage works on all that the one before kept, and its decisions take effect: documents without a known
language go; of each group of near copies the least id stays; documents with benchmark windows go; secrets
are replaced by a mark; what is left is cut and packed into batches, with the text of each piece.

Defined cases
    null or empty text: of no known language, so it goes. Null ids: kept and judged by their texts; of those with
    the same words one stays. Texts of any length are taken whole. Repeated rows: one stays. Ties: the least id, then
    text hash. Empty tables give an empty result. Columns beyond those of ``documents``, whatever their names, pass
    through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import decontaminate, jaccard, language, packing, secrets
from gridloom.llm.scratch import Scratch


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def benchmark_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, texts=True)


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", near_duplicates),
    ("decontamination", benchmark_windows),
    ("secret_scan", secret_scan),
    ("packing", length_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs


#: SQL can't express the trained model of the first stage; the tests hold run() against plain Python instead.
ORACLE_SQL = None
