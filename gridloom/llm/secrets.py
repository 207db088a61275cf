"""Secret scans in DataFrame expressions only.

Fixed patterns give the base spans. Beyond them, long runs of a character class are candidates. They are sought in the
text with the base spans, and then the allow-list's stretches, blanked out by line feeds, so that what is known or
harmless ends a run and the rest of it is judged by its own windows: a window slides over a run, its character counts
change by one character in and one out, and with them the sum that Shannon's entropy needs. A run with a letter and a
digit whose windows reach the class's threshold is a span, and is blanked out for the next class.

A text's matches are placed without Python: the pieces between the matches and the matches themselves, both in order,
have lengths whose running sum is where each match starts. Texts without a match, nearly all, cost one search per
pattern.

Defined cases
    null or empty text: no spans. Null ids and repeated rows are scanned like any other row. Texts of any length are
    scanned whole, in time proportional to their length. Ties: spans with one start come in the order of their kinds; a
    window that just reaches the threshold counts. An empty table gives an empty result. ``scan`` ignores other columns;
    ``redact`` passes them through, and a null text stays null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .native import bind

#: Fixed patterns: kind, pattern whose group 1 is measured, least length of that group.
BASE = (
    ("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6),
    ("access", r"(AKIA[A-Z0-9]{16,})", 20),
    ("hex", r"([0-9a-f]{24,})", 24),
)
#: Character classes: kind, characters, least bits per character of some window.
CLASSES = (
    ("entropy_hex", "0123456789abcdefABCDEF", 3.0),
    ("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 3.7),
)
WINDOW = 20
#: Stretches that aren't secret, each blanked out of the text before candidates are sought.
ALLOWED = (
    r"(?i)example|sample|dummy|placeholder|changeme|redacted",
    r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    r"(.)\1{7}",
    r"(?i)abcdefgh|01234567|12345678|qwertyui",
)
BLANK = "\n"
MARK = "[SECRET]"
CHUNK = 512
#: Windows of a run that are taken at a time.
STRETCH = 256
_SPANS = "array<struct<start:int,end:int,text:string>>"


def _matches(text: Column, pattern: str) -> tuple[Column, Column]:
    """(matches as (piece before, match, its group 1), what stands after the last one) of a text that has one."""
    whole, value = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    pieces = F.split(text, pattern, -1)
    zipped = F.zip_with(F.arrays_zip(F.slice(pieces, F.lit(1), F.size(whole)).alias("piece"), whole.alias("match")), value, lambda x, v: F.struct(x["piece"].alias("piece"), x["match"].alias("match"), v.alias("value")))
    return zipped, F.element_at(pieces, -1)


def _chunks(items: Column) -> Column:
    """An array in stretches, so that folds over it don't copy all that they have gathered at every step."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int")), lambda k: F.slice(items, k * CHUNK + 1, F.lit(CHUNK)))


def _fold(items: Column, state: Column, step) -> Column:
    """``step(state with at and out, item)`` over a long array; returns all of ``out`` in order."""
    none = F.array().cast(_SPANS)

    def chunk(acc: Column, part: Column) -> Column:
        return bind(F.aggregate(part, F.struct(acc["at"].alias("at"), none.alias("out")), step), lambda inner: F.struct(inner["at"].alias("at"), F.concat(acc["out"], inner["out"]).alias("out")))

    return F.aggregate(_chunks(items), F.struct(state.alias("at"), none.alias("out")), chunk)["out"]


def _spans(found: Column, good) -> Column:
    """(start, end, text) of the matches that are good; offsets in code points."""

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["piece"])
        end = start + F.length(x["match"])
        mine = F.when(good(x), F.array(F.struct(start.alias("start"), end.alias("end"), x["match"].alias("text")))).otherwise(F.array().cast(_SPANS))
        return F.struct(end.alias("at"), F.concat(acc["out"], mine).alias("out"))

    return _fold(found, F.lit(0), step)


def _placed(text: Column, pattern: str, measured: int) -> Column:
    """Matches of a pattern as (start, end, text), those whose group 1 is long enough."""
    none = F.array().cast(_SPANS)
    found, _ = _matches(text, pattern)
    return F.coalesce(F.when(text.rlike(pattern), bind(found, lambda x: _spans(x, lambda m: F.length(m["value"]) >= measured))).otherwise(none), none)


def _blanked(text: Column, pattern: str, good) -> Column:
    """The text with its good matches as so many line feeds."""
    found, last = _matches(text, pattern)
    joined = F.array_join(F.transform(found, lambda x: F.concat(x["piece"], F.when(good(x), F.repeat(F.lit(BLANK), F.length(x["match"]))).otherwise(x["match"]))), "")
    return F.when(text.rlike(pattern), F.concat(joined, last)).otherwise(text)


def _reaches(run: Column, alphabet: str, window: int, bits: float) -> Column:
    """Does some window of a run have that entropy, in bits per character?

    The counts of a window's characters are packed in a few longs. A step changes two of them, that of the character
    which comes and that of the one which goes, whatever the alphabet. Windows are taken in stretches, and no
    stretch is begun after one that has such a window.
    """
    width = window.bit_length()
    held = 62 // width
    weight = lambda c: F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))

    def searched(places: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            return bind(F.struct(F.get(places, i).alias("come"), F.get(places, F.when(i >= acc["first"] + window, i - window)).alias("gone")), lambda ends: moved(acc, ends["come"], ends["gone"], i))

        def moved(acc: Column, come: Column, gone: Column, i: Column) -> Column:
            count = lambda x: F.call_function("shiftright", F.get(acc["counts"], x["slot"]), x["shift"]).bitwiseAND(F.lit((1 << width) - 1).cast("long")).cast("double")
            one = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x["shift"])
            same = F.coalesce((come["slot"] == gone["slot"]) & (come["shift"] == gone["shift"]), F.lit(False))
            less = F.when(gone.isNull(), F.lit(0.0)).otherwise(bind(count(gone), lambda c: weight(c - 1) - weight(c)))
            more = bind(count(come), lambda c: weight(c + 1) - weight(c))
            total = F.when(same, acc["sum"]).otherwise(acc["sum"] + less + more)
            counts = F.when(same, acc["counts"]).otherwise(F.transform(acc["counts"], lambda c, k: c + F.when(k == come["slot"], one(come)).otherwise(F.lit(0).cast("long")) - F.when(F.coalesce(k == gone["slot"], F.lit(False)), one(gone)).otherwise(F.lit(0).cast("long"))))
            entropy = F.when(i >= acc["first"] + window - 1, F.lit(math.log2(window)) - total / window).otherwise(F.lit(0.0))
            return F.struct(acc["first"].alias("first"), counts.alias("counts"), total.alias("sum"), F.greatest(acc["peak"], entropy).alias("peak"))

        def peak(first: Column) -> Column:
            start = F.struct(first.alias("first"), F.array_repeat(F.lit(0).cast("long"), -(-len(alphabet) // held)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("peak"))
            last = F.least(first + STRETCH + window - 2, F.size(places) - 1)
            return F.aggregate(F.sequence(first, last), start, step)["peak"]

        stretches = F.sequence(F.lit(0), F.floor((F.size(places) - window) / STRETCH).cast("int"))
        return F.exists(stretches, lambda k: F.round(peak(k * STRETCH), 9) >= bits)

    place = lambda c: bind(F.instr(F.lit(alphabet), c) - 1, lambda at: F.struct(F.floor(at / held).cast("int").alias("slot"), (at % held * width).alias("shift")))
    return bind(F.transform(F.split(run, ""), place), searched)


def _without(text: Column, pattern: str, least: int) -> Column:
    return bind(text, lambda t: _blanked(t, pattern, lambda x: F.length(x["value"]) >= least))


def _class_pattern(alphabet: str, window: int) -> str:
    kind = "[" + "".join("\\" + c if c in "+/_-" else c for c in alphabet) + "]"
    return f"({kind}{{{window},}}+)"


def _good(alphabet: str, bits: float, window: int):
    return lambda x: x["match"].rlike("[0-9]") & x["match"].rlike("[A-Za-z]") & _reaches(x["match"], alphabet, window, bits)


def _labelled(spans: Column, kind: str, rank: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind")))


def _found(documents: DataFrame, text_col: str, window: int, allowed: tuple[str, ...]) -> DataFrame:
    """All columns and base spans by kind, base ones and all."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = documents.withColumn("__text", text)
    rows = rows.select("*", *(_placed(F.col("__text"), pattern, least).alias(f"__{kind}") for kind, pattern, least in BASE))
    base = F.array_sort(F.concat(*(_labelled(F.col(f"__{kind}"), kind, k) for k, (kind, _, _) in enumerate(BASE))))
    rows = rows.withColumn("__base", base)
    patterns = [_class_pattern(alphabet, window) for _, alphabet, _ in CLASSES]
    # only texts with a long run of some class, few of all, are blanked and searched further
    runs = F.lit(False)
    for pattern in patterns:
        runs = runs | F.col("__text").rlike(pattern)
    rest = F.col("__text")
    for _, pattern, least in BASE:
        rest = _without(rest, pattern, least)
    for rule in allowed:
        rest = _without(rest, rule if "\\1" in rule else f"({rule})", 0)
    rows = rows.withColumn("__rest", F.when(runs, rest).otherwise(F.lit("")))
    known = F.col("__base")
    none = F.array().cast(_SPANS)
    for k, ((kind, alphabet, bits), pattern) in enumerate(zip(CLASSES, patterns, strict=True)):
        text, good = F.col("__rest"), _good(alphabet, bits, window)
        found, last = _matches(text, pattern)
        judged = F.transform(found, lambda x: F.struct(x["piece"].alias("piece"), x["match"].alias("match"), good(x).alias("good")))  # noqa: B023
        rows = rows.withColumn("__judged", F.when(text.rlike(pattern), judged)).withColumn("__last", F.when(text.rlike(pattern), last))
        spans = F.coalesce(F.when(F.col("__judged").isNotNull(), _spans(F.col("__judged"), lambda x: x["good"])).otherwise(none), none)
        rows = rows.withColumn(f"__{kind}", _labelled(spans, kind, len(BASE) + k))
        joined = F.array_join(F.transform("__judged", lambda x: F.concat(x["piece"], F.when(x["good"], F.repeat(F.lit(BLANK), F.length(x["match"]))).otherwise(x["match"]))), "")
        rows = rows.withColumn("__rest", F.when(F.col("__judged").isNotNull(), F.concat(joined, F.col("__last"))).otherwise(text)).drop("__judged", "__last")
        known = F.concat(known, F.col(f"__{kind}"))
    return rows.withColumn("__all", F.array_sort(known))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(documents: DataFrame, *, window: int = WINDOW, allowed: tuple[str, ...] = ALLOWED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, base spans' numbers by kind, base and spans (arrays of start, rank, end, kind)."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = _found(rows, "text", window, allowed)
    return found.select("doc_id", *(F.size(f"__{kind}").cast("long").alias(f"n_{kind}") for kind, _, _ in BASE), F.col("__base").alias("base"), F.col("__all").alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The scan's spans as text: base ones hashed, all of them joined."""
    return found.select("doc_id", *(f"n_{kind}" for kind, _, _ in BASE), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redact(documents: DataFrame, *, window: int = WINDOW, allowed: tuple[str, ...] = ALLOWED, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """Documents with all their columns; every span of a text is replaced by a mark. ``length_col``, where the
    documents have it, becomes the new length of a changed text."""
    found = _found(documents, text_col, window, allowed)

    def gap(acc: Column, x: Column) -> Column:
        """What is kept before a span, if it doesn't overlap or touch the one before."""
        fresh = F.when((x["start"] > acc["at"]) | (acc["at"] < 0), F.array(F.struct(F.greatest(acc["at"], F.lit(0)).alias("start"), x["start"].alias("end"), F.lit("").alias("text")))).otherwise(F.array().cast(_SPANS))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.concat(acc["out"], fresh).alias("out"))

    def rest(characters: Column) -> Column:
        kept = F.transform(_fold(F.col("__all"), F.lit(-1), gap), lambda g: F.concat(F.array_join(F.slice(characters, g["start"] + 1, g["end"] - g["start"]), ""), F.lit(MARK)))
        end = F.array_max(F.transform("__all", lambda x: x["end"]))
        return F.concat(F.array_join(kept, ""), F.array_join(F.slice(characters, end + 1, F.greatest(F.size(characters) - end, F.lit(0))), ""))

    hit = F.size("__all") > 0
    changed = found.withColumn("__new", F.when(hit, bind(F.split("__text", ""), rest)).otherwise(F.col(text_col).cast("string")))
    out = []
    for name in documents.columns:
        if name == text_col:
            out.append(F.col("__new").alias(name))
        elif name == length_col:
            out.append(F.when(hit, F.length("__new")).otherwise(F.col(name)).cast(documents.schema[name].dataType).alias(name))
        else:
            out.append(F.col(name))
    return changed.select(*out)
