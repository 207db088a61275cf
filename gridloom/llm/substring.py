"""Exact repeats of word windows between documents, found by level-wise doubling.

Level 0 takes windows of half the length asked for, and of these only the ones that are least by hash among
the ``half + 1`` that one full window holds: equal full windows choose equal halves, so a full window that
repeats has a chosen half that repeats. Halves that repeat alone are extended to the full length; full
windows that repeat alone are extended to twice that length, and so on until no candidate survives. What
moves between machines is one entry per distinct hash and block of documents (see ``meeting``).

Halves meet by 64-bit hashes, which only picks candidates. From the full length on, a window is known by a
128-bit cryptographic digest of its own words, so a collision of the hashes never removes a word.

Copies of a whole word sequence (by SHA-256) are settled before: all but the least id of such a class consist of
repeated windows and are never a window's first holder, so they take no part in the levels.

Defined cases
    null or empty text: no words. Fewer words than the window: nothing repeats. A text of any length is taken
    whole, words of any length too; its windows travel in rows of bounded size. A null id is never compared
    and keeps all its words. Rows that repeat an id count as one document: a window needs a smaller id
    elsewhere. Ties: of equal windows the one in the least id stays, wherever in the text; two of one document both
    stay or both go. An empty table gives an empty result. Other columns are ignored here and passed through by
    ``clean``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import meeting
from . import textkit as tk
from .hot import heavy_keys, spread_join
from .scratch import Scratch, small_batches
from .texts import chosen, keyed

_FIELDS = [("kind", pa.int32()), ("doc_id", pa.int64()), ("th", pa.int64()), ("n_words", pa.int64()), ("level", pa.int32()), ("value", pa.binary()), ("block", pa.int64()), ("docs", pa.binary()), ("ths", pa.binary()), ("owner", pa.binary()), ("pos", pa.binary()), ("hash", pa.binary()), ("guard", pa.binary())]
_ARROW = pa.schema(_FIELDS)
_SPARK = "kind int, doc_id long, th long, n_words long, level int, value binary, block long, docs binary, ths binary, owner binary, pos binary, hash binary, guard binary"
DOCUMENT, BLOCK, WINDOWS = 0, 1, 2
#: Entries of a state row.
STATE = 1 << 14


def _batch(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind) for name, kind in _FIELDS], schema=_ARROW)


class _Blocks:
    """Gathers entries of documents and hands them out as state rows."""

    def __init__(self):
        context = TaskContext.get()
        self.next = (context.partitionId() if context else 0) << 32
        self.clear()

    def clear(self) -> None:
        self.docs, self.ths, self.owner, self.pos, self.hash, self.guard, self.size = [], [], [], [], [], [], 0

    def add(self, doc: int, th: int, pos: np.ndarray, hashes: np.ndarray, guards: np.ndarray | None = None) -> None:
        self.owner.append(np.full(len(pos), len(self.docs), dtype=np.int32))
        self.docs.append(doc)
        self.ths.append(th)
        self.pos.append(pos.astype(np.int32))
        self.hash.append(hashes)
        if guards is not None:
            self.guard.append(guards)
        self.size += len(pos)

    def out(self, at_least: int = 1) -> Iterator[pa.RecordBatch]:
        if self.size >= at_least:
            self.next += 1
            yield _batch(kind=[BLOCK], block=[self.next], docs=[tk.pack64(np.array(self.docs, dtype=np.int64))], ths=[tk.pack64(np.array(self.ths, dtype=np.int64))], owner=[np.concatenate(self.owner).tobytes()], pos=[np.concatenate(self.pos).tobytes()], hash=[np.concatenate(self.hash).tobytes()], guard=[b"".join(x.tobytes() for x in self.guard)])
            self.clear()


def _sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours, by doubling."""
    pick, span, now = (np.minimum if least else np.maximum), 1, values
    while 2 * span <= width:
        now = pick(now[:-span], now[span:]) if len(now) > span else now[:0]
        span *= 2
    if rest := width - span:
        now = pick(now[:-rest], now[rest:]) if len(now) > rest else now[:0]
    return now


def _chosen_halves(words: tk.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash per word of the half window that starts there, the full windows' first words, and for each full
    window the hash of its chosen half."""
    half = window // 2
    hashes, at = words.grams(half)
    values = np.full(len(words), np.iinfo(np.uint64).max, dtype=np.uint64)
    values[at] = hashes
    _, full = words.grams(window)
    least = _sliding(values, window - half + 1, True)
    return values, full, least[full] if len(full) else least[:0]


def _scan(window: int):
    """Per document its words' number and digest; per block the chosen halves of documents not seen before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        state = _Blocks()
        for batch in batches:
            doc, null = tk.ids(batch.column("doc_id"))
            th = batch.column("th").to_numpy(zero_copy_only=False)
            raw, offsets = tk.flat(batch.column("text"))
            for low, high in tk.blocks(offsets):
                words = tk.Words(raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], tk.SPACED, False)
                text, border = words.joined()
                digests = [hashlib.sha256(text[a:b]).digest() for a, b in zip(border, border[1:], strict=False)]
                counts = words.counts()
                yield _batch(kind=[DOCUMENT] * (high - low), doc_id=batch.column("doc_id").slice(low, high - low), th=th[low:high], n_words=counts, value=digests)
                _, full, halves = _chosen_halves(words, window)
                border = np.searchsorted(full, words.first).tolist()
                for row in sorted(np.flatnonzero(counts >= window).tolist(), key=lambda row: doc[low + row]):
                    if null[low + row] or seen.get(digests[row], np.inf) <= doc[low + row]:
                        continue
                    seen[digests[row]] = int(doc[low + row])
                    mine = np.unique(halves[border[row] : border[row + 1]])
                    state.add(int(doc[low + row]), int(th[low + row]), np.zeros(len(mine), dtype=np.int32), mine)
                yield from state.out(STATE)
        yield from state.out()

    return run


def _match(bits: int, level: int, window: int):
    """Brings a block's entries and what is known of them together: which documents go on, and what is removed."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, back = [], right.to_pylist()
        for row in left.to_pylist() if back else []:
            again, later = meeting.flags_of(row, back, bits)
            docs, ths = tk.unpack64(row["docs"]), tk.unpack64(row["ths"])
            owner, pos, hashes = (np.frombuffer(row[k], dtype=t) for k, t in (("owner", np.int32), ("pos", np.int32), ("hash", np.uint64)))
            found = np.unique(owner[again])
            if level < window:
                order = owner[again]
                border = np.searchsorted(order, found).tolist() + [len(order)]
                kept = hashes[again]
                out.append(_batch(kind=[WINDOWS] * len(found), doc_id=docs[found], th=ths[found], level=[level] * len(found), value=[kept[a:b].tobytes() for a, b in zip(border, border[1:], strict=False)]))
                continue
            spans = [b""] * len(found)
            if level == window and later.any():
                place = np.searchsorted(found, owner[later])
                border = np.searchsorted(place, np.arange(len(found) + 1)).tolist()
                gone = pos[later]
                spans = [_merge(gone[a:b], window).tobytes() for a, b in zip(border, border[1:], strict=False)]
            out.append(_batch(kind=[WINDOWS] * len(found), doc_id=docs[found], th=ths[found], level=[level] * len(found), value=spans))
            key = owner[again].astype(np.int64) << 32 | pos[again]
            partner = np.searchsorted(key, key + level)
            both = np.flatnonzero((partner < len(key)) & (key[np.minimum(partner, len(key) - 1)] == key + level)) if len(key) else key
            if len(both):
                kept, guards, mine = hashes[again], np.frombuffer(row["guard"], dtype=np.uint64)[again], owner[again][both]
                used, mine = np.unique(mine, return_inverse=True)
                out.append(_batch(kind=[BLOCK], block=[row["block"]], docs=[tk.pack64(docs[used])], ths=[tk.pack64(ths[used])], owner=[mine.astype(np.int32).tobytes()], pos=[pos[again][both].tobytes()], hash=[tk.join_grams(kept[both], kept[partner[both]]).tobytes()], guard=[tk.join_grams(guards[both], guards[partner[both]]).tobytes()]))
        return pa.Table.from_batches(out, schema=_ARROW)

    return run


def _merge(starts: np.ndarray, window: int) -> np.ndarray:
    """Borders of the runs that windows of ordered starts cover: start, end, start, end ..."""
    if not len(starts):
        return np.zeros(0, dtype=np.int32)
    apart = np.flatnonzero(np.diff(starts) > window)
    return np.stack([np.concatenate([starts[:1], starts[apart + 1]]), np.concatenate([starts[apart], starts[-1:]]) + window], axis=1).astype(np.int32).ravel()


def _full_windows(window: int):
    """State of the full windows whose chosen half is among the document's repeated ones, by digests of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Blocks()
        for batch in batches:
            doc, _ = tk.ids(batch.column("doc_id"))
            th = batch.column("th").to_numpy(zero_copy_only=False)
            raw, offsets = tk.flat(batch.column("text"))
            values = batch.column("value")
            for low, high in tk.blocks(offsets):
                words = tk.Words(raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], tk.SPACED, False)
                _, full, halves = _chosen_halves(words, window)
                text, _, start, end = words.joined_spans()
                border = np.searchsorted(full, words.first).tolist()
                for row in range(high - low):
                    part = slice(border[row], border[row + 1])
                    known = np.frombuffer(values[low + row].as_buffer(), dtype=np.uint64)
                    held = full[part][np.isin(halves[part], known)]
                    if len(held):
                        state.add(int(doc[low + row]), int(th[low + row]), held - words.first[row], *tk.window_digests(text, start[held], end[held + window - 1]))
                yield from state.out(STATE)
        yield from state.out()

    return run


def _level(scratch: Scratch, state: DataFrame, entries: int, level: int, window: int) -> DataFrame:
    """One level: written rows of documents that hold repeated windows, and the blocks of the next level."""
    tasks = meeting.tasks_for(entries)
    back = meeting.repeated(state, tasks)
    met = state.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_match(meeting.bits_for(tasks), level, window), _SPARK)
    return scratch.table(met, f"level{level}")


def _entries(state: DataFrame) -> int:
    return (state.agg(F.sum(F.length("hash"))).first()[0] or 0) // 8


def find(documents: DataFrame, *, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, removals): per document doc_id, th, n_words, digest, copy_of; per document that loses words
    to a smaller id, doc_id, th, spans (packed int32 word borders), and the longest level with a repeat."""
    spark = documents.sparkSession
    small_batches(spark)
    scratch = Scratch(spark)
    rows = keyed(documents, id_col, text_col)
    scan = scratch.table(rows.mapInArrow(_scan(window), _SPARK), "scan")
    stats = scan.where(F.col("kind") == DOCUMENT).select("doc_id", "th", "n_words", F.col("value").alias("digest"))
    firsts = stats.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window)).groupBy("digest").agg(F.min("doc_id").alias("copy_of"))
    stats = spread_join(stats, firsts, "digest", heavy_keys(stats, "digest"), "left", by="doc_id")
    stats = stats.withColumn("copy_of", F.when((F.col("n_words") >= window) & (F.col("doc_id") > F.col("copy_of")), F.col("copy_of")))
    stats = scratch.table(stats, "documents")
    state = scan.where(F.col("kind") == BLOCK)
    first = _level(scratch, state, _entries(state), window // 2, window)
    alone = stats.where(F.col("copy_of").isNull()).select("doc_id", "th").distinct()
    # a row that repeats an id may stand in several blocks: its text is the same, so any one will do
    keys = first.select("doc_id", "th", "value").groupBy("doc_id", "th").agg(F.min("value").alias("value")).join(alone, ["doc_id", "th"], "left_semi")
    keys = scratch.table(keys, "keys")
    state = scratch.table(chosen(rows, keys).dropDuplicates(["doc_id", "th"]).mapInArrow(_full_windows(window), _SPARK), "windows")
    for done in ("scan", "keys", f"level{window // 2}"):
        scratch.drop(done)
    found, level, levels = None, window, []
    while entries := _entries(state):
        done = _level(scratch, state, entries, level, window)
        rows_of = done.where(F.col("kind") == WINDOWS).select("doc_id", "th", "level", "value")
        found = rows_of if found is None else found.unionByName(rows_of)
        levels.append(level)
        state, level = done.where(F.col("kind") == BLOCK), 2 * level
    if found is None:
        found = spark.createDataFrame([], "doc_id long, th long, level int, value binary")
    removals = found.groupBy("doc_id", "th").agg(F.max(F.when(F.length("value") > 0, F.col("value"))).alias("spans"), F.max("level").alias("longest"))
    removals = scratch.table(removals, "removals")
    for done in ("windows", *(f"level{x}" for x in levels)):
        scratch.drop(done)
    return stats, removals


def _kept(window: int, texts: bool):
    """Rests of documents without the words of their spans, and the rests' digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = tk.flat(batch.column("text"))
            for low, high in tk.blocks(offsets):
                words = tk.Words(raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], tk.SPACED, False)
                gone, digest, kept = [], [], []
                for row in range(high - low):
                    spans = np.frombuffer(batch.column("spans")[low + row].as_buffer(), dtype=np.int32).tolist()
                    at, end, parts, n = int(words.first[row]), int(words.first[row + 1]), [], 0
                    begin = at
                    for a, b in zip(spans[::2], spans[1::2], strict=True):
                        parts.append((at, begin + a))
                        at = begin + b
                        n += b - a
                    parts.append((at, end))
                    rest = b" ".join(words.text(a, b) for a, b in parts if b > a)
                    gone.append(n)
                    digest.append(hashlib.sha256(rest).hexdigest())
                    kept.append(rest.decode() if texts else None)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), batch.column("th").slice(low, high - low), pa.array(gone, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.string())], names=["doc_id", "th", "gone", "rest", "kept"])

    return run


_REST = "doc_id long, th long, gone long, rest string, kept string"


def summary(documents: DataFrame, *, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, copy_of (least id with the same words, if smaller)
    and longest (the longest level at which it shares a window; null if none or a copy)."""
    stats, removals = find(documents, window=window, id_col=id_col, text_col=text_col)
    rests = chosen(keyed(documents, id_col, text_col), removals.where("spans is not null").select("doc_id", "th", "spans")).dropDuplicates(["doc_id", "th"]).mapInArrow(_kept(window, False), _REST)
    met = stats.join(rests.select("doc_id", "th", "gone", "rest"), ["doc_id", "th"], "left").join(removals.select("doc_id", "th", "longest"), ["doc_id", "th"], "left")
    copy = F.col("copy_of").isNotNull()
    return met.select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("rest", F.lower(F.hex("digest")))).alias("kept_sha256"), "copy_of", "longest",
    )


def clean(documents: DataFrame, *, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with all their columns; a text that loses words is what is left of them, joined by spaces."""
    stats, removals = find(documents, window=window, id_col=id_col, text_col=text_col)
    rests = chosen(keyed(documents, id_col, text_col), removals.where("spans is not null").select("doc_id", "th", "spans")).dropDuplicates(["doc_id", "th"]).mapInArrow(_kept(window, True), _REST)
    copies = stats.where("copy_of is not null").select("doc_id", "th", F.lit("").alias("kept")).distinct()
    changed = rests.select("doc_id", "th", "kept").unionByName(copies).toDF("__id", "__hash", "__kept")
    met = documents.join(changed, (F.col(id_col).cast("long") == F.col("__id")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__hash")), "left")
    return met.withColumn(text_col, F.coalesce("__kept", text_col)).select(*documents.columns)


