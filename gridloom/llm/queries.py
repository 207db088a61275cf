"""Queries of the subpackage over the tables of a data folder, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, jaccard, language, line_rules, packing, secrets, substring, toxicity, weak_quality
from . import decontaminate as decontamination
from .oracle import TEXTS
from .scratch import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op7_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.score(_table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(_table(spark, sf_dir, "documents")).drop("th")


def op8_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_counts(_table(spark, sf_dir, "documents")).drop("th")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts written from the conversations' roles, parsed as running lines without roles or borders of turns.
    Each half of the conversations is parsed by a model that the roles of the other half taught. What was found is
    given by the turns that were written."""
    raw = chat.transcripts(_table(spark, sf_dir, "conversations"))
    rows, half = Scratch(spark).table(chat.placed(raw), "placed"), chat.half("conv_id")
    parts = [chat.by_turn(chat.parse(chat.lines(rows.where(half == k)), raw.where(half != k), turns=False)) for k in (0, 1)]
    found = parts[0].unionByName(parts[1])
    return found.select("conv_id", F.col("position").alias("turn"), "n_lines", F.array_join("line_roles", ",").alias("line_roles"), F.size("turns").alias("n_turns"), F.sha2("rendered", 256).alias("rendered_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_table(spark, sf_dir, "documents")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.summary(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_chat_format": op2_chat_format,
        "op3_toxicity": op3_toxicity,
        "op4_secret_scan": op4_secret_scan,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_language_id": op6_language_id,
        "op7_weak_quality": op7_weak_quality,
        "op8_jaccard_join": op8_jaccard_join,
        "op8_jaccard_links": op8_jaccard_links,
        "op9_decontamination": op9_decontamination,
        "op10_quality_rules": op10_quality_rules,
    }


def oracle_sql() -> dict[str, str]:
    return dict(TEXTS)
