"""Whole texts of chosen documents, without moving those of the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a sieve for each chosen document, and the least and greatest logarithm of a sieve's size.
BITS_A_KEY, LEAST_BITS, MOST_BITS = 64, 12, 26


def keyed(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, th): th is a hash of the text, so that rows which repeat an id keep their own texts apart."""
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("th", F.xxhash64("text"))


def sifted(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose value of a column is among the keys', and by chance a few others: what an exact join has to shuffle.

    ``keys`` is read twice: a written table. The sieve that is broadcast has 64 bits a key or more, but at most 2**26, in
    2**20 longs; with so many keys that these would hold most rows back no longer, there is none and all pass.
    """
    marked = _marked(rows, keys, column)
    return rows if marked is None else marked.where("_maybe").drop("_maybe")


def parted(rows: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame | None]:
    """What ``sifted`` gives and all other rows, None where there is no sieve; a null is a value like others."""
    marked = _marked(rows, keys, column)
    return (rows, None) if marked is None else tuple(marked.where(f).drop("_maybe") for f in ("_maybe", "not _maybe"))


def _marked(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame | None:
    n = keys.count()
    if 2 * n > 1 << MOST_BITS:
        return None
    bits = min(MOST_BITS, max(LEAST_BITS, (BITS_A_KEY * n).bit_length()))
    word, bit = f"(xxhash64({column}) & {(1 << bits) - 1}) >> 6", f"shiftleft(1L, cast(xxhash64({column}) & 63 as int))"
    sieve = keys.select(F.expr(word).alias("_word"), F.expr(bit).alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    met = rows.withColumn("_word", F.expr(word)).join(F.broadcast(sieve), "_word", "left")
    return met.withColumn("_maybe", F.expr(f"coalesce((_bits & {bit}) != 0, false)")).drop("_word", "_bits")


def chosen(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``keyed`` documents with a key (doc_id, th) in ``keys``, a written table, with the keys' other columns."""
    return sifted(rows, keys, "doc_id").join(keys, ["doc_id", "th"])
