"""Line-first quality rules in DataFrame expressions only.

Each line with a word is judged by itself: it fails without sentence punctuation, as navigation (a row of
short parts between bars or arrows), as boilerplate (fixed phrases), or if symbols make up much of it. Failing
lines go; a document goes if it is too short, repeats itself, or loses too much of its text with the lines.

Everything is one projection over the row: no shuffle, no explode, no Python. Repeated three-word windows are
found by sorting packed (hash, position) longs, so a text costs n log n however often it repeats itself. Windows
that meet there have their words compared; where a hash brought different ones together, the windows that met are
sorted again by their words.

Defined cases
    null or empty text: no words, no lines; it fails the base rules (fewer than ``min_words`` words). Null ids
    and repeated rows are judged like any other row. Texts of any length are judged whole, in n log n. Ties: shares
    equal to a limit pass. An empty table gives an empty result. ``judge`` ignores other columns; ``clean`` passes
    them through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import BLANK, bind, total, words

SYMBOLS = r"[#*$%&|<>]"
#: Marks that end a sentence, at a line's end or before white space inside it.
SENTENCE = r"[.!?\x{2026}\x{3002}][\"')\]\x{00BB}\x{201D}\x{2019}]*(\s|$)"
#: Three parts or more between bars, arrows or bullets.
NAVIGATION = r"([|\x{00BB}\x{203A}\x{2022}][^|\x{00BB}\x{203A}\x{2022}]*){3}"
#: Phrases of pages' frames.
BOILERPLATE = r"(?i)(all rights reserved|privacy policy|terms of (use|service)|cookie policy|accept cookies|licensed under|click here|read more|sign in|log in|subscribe (now|to)|enable javascript|skip to content|follow us on|share on)"


#: Hash that brings equal windows together.
_MEET = F.xxhash64


def line_fails(line: Column, max_symbol_percent: int = 10) -> Column:
    """Does one line fail? Its symbols count against its length in code points."""
    return (
        ~line.rlike(SENTENCE)
        | line.rlike(NAVIGATION)
        | line.rlike(BOILERPLATE)
        | (100 * F.regexp_count(line, F.lit(SYMBOLS)) > max_symbol_percent * F.length(line))
    )


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{BLANK[1:-1]}]"))


def _repeat_words(held: Column) -> Column:
    """Words of an array that lie in three-word windows found twice or more."""
    return bind(held, _repeats)


def _repeats(held: Column) -> Column:
    n = F.size(held)
    bits = F.length(F.bin(n))  # of a position
    low = F.expr("9223372036854775807L")

    def packed(parts: Column, shift: Column) -> Column:
        mask = F.call_function("shiftright", low, shift)
        hashed = F.transform(parts, lambda word, i: F.call_function("shiftleft", _MEET(word, F.get(parts, i + 1), F.get(parts, i + 2)).bitwiseAND(mask), shift).bitwiseOR(i.cast("long")))
        return F.sort_array(F.slice(hashed, 1, F.greatest(F.size(parts) - 2, F.lit(0))))

    def window(at: Column) -> Column:
        return F.struct(*(F.get(held, at + k).alias(f"w{k}") for k in range(3)))

    def near(values: Column, same) -> Column:
        """Values that are the same as the one before or after."""
        return F.filter(values, lambda x, j: F.coalesce(same(x, F.get(values, j - 1)), F.lit(False)) | F.coalesce(same(x, F.get(values, j + 1)), F.lit(False)))

    def covered(again: Column, shift: Column) -> Column:
        of = lambda x: F.call_function("shiftright", x, shift)
        keep = F.call_function("shiftleft", F.lit(1).cast("long"), shift) - 1
        at = lambda x: x.bitwiseAND(keep).cast("int")
        mixed = F.filter(again, lambda x, j: F.coalesce((of(x) == of(F.get(again, j - 1))) & (window(at(x)) != window(at(F.get(again, j - 1)))), F.lit(False)))
        by_words = bind(F.sort_array(F.transform(again, lambda x: F.struct(window(at(x)).alias("w"), at(x).alias("at")))), lambda order: F.transform(near(order, lambda x, y: x["w"] == y["w"]), lambda x: x["at"]))
        places = F.sort_array(F.when(F.size(mixed) > 0, by_words).otherwise(F.transform(again, at)))
        return bind(places, lambda p: total(F.transform(p, lambda x, j: F.least(F.lit(3).cast("long"), F.coalesce((x - F.get(p, j - 1)).cast("long"), F.lit(3).cast("long"))))))

    def counted(order: Column, shift: Column) -> Column:
        met = near(order, lambda x, y: F.call_function("shiftright", x, shift) == F.call_function("shiftright", y, shift))
        return bind(met, lambda again: F.when(F.size(again) == 0, F.lit(0).cast("long")).otherwise(covered(again, shift)))

    return F.when(n < 4, F.lit(0).cast("long")).otherwise(bind(bits, lambda shift: bind(packed(held, shift), lambda order: counted(order, shift))))


def judge(documents: DataFrame, *, min_words: int = 50, max_repeat_percent: int = 50, max_lost_percent: int = 50, max_symbol_percent: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the counts, n_lines, n_failed_lines, chars and chars_lost of its lines, base_failed and kept."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    parts = documents.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    parts = parts.select("doc_id", F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"), words(F.col("text")).alias("words"), lines_with_words(F.col("text")).alias("lines"))
    length = lambda line: F.length(line).cast("long")
    counted = parts.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), _repeat_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), total(F.transform("lines", length)).alias("chars"),
        F.filter("lines", lambda line: line_fails(line, max_symbol_percent)).alias("failed"),
    )
    found = counted.withColumn("n_failed_lines", F.size("failed").cast("long")).withColumn("chars_lost", total(F.transform("failed", length))).drop("failed")
    bad = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return found.withColumn("base_failed", bad).withColumn("kept", ~bad & (100 * F.col("chars_lost") <= max_lost_percent * F.col("chars")))


def clean(documents: DataFrame, *, min_words: int = 50, max_repeat_percent: int = 50, max_lost_percent: int = 50, max_symbol_percent: int = 10, text_col: str = "text") -> DataFrame:
    """Documents that are kept, with all their columns, their texts without failing lines."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    length = lambda line: F.length(line).cast("long")
    verdict = bind(lines_with_words(text), lambda lines: bind(F.filter(lines, lambda line: ~line_fails(line, max_symbol_percent)), lambda good: F.struct(total(F.transform(lines, length)).alias("chars"), total(F.transform(good, length)).alias("left"), F.array_join(good, "\n").alias("text"))))
    held = bind(words(text), lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("again")))
    marked = documents.select("*", verdict.alias("__lines"), held.alias("__words"))
    good = (F.col("__words.n") >= min_words) & (100 * F.col("__words.again") <= max_repeat_percent * F.col("__words.n")) & (100 * (F.col("__lines.chars") - F.col("__lines.left")) <= max_lost_percent * F.col("__lines.chars"))
    return marked.where(good).withColumn(text_col, F.col("__lines.text")).select(*documents.columns)
