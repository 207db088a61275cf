"""Benchmark decontamination: a broadcast hash set of test n-grams scanned over training token windows.

The windows of the benchmark texts form a sorted array of 64-bit hashes that every task holds, each with its
place in one buffer of the benchmark's words. A document's window hashes are looked up in it; each hit is
verified word by word against that buffer, so a hash collision never marks a word. The scan is one pass without
a shuffle.

The broadcast is bounded: a benchmark that may have more than ``max_broadcast_windows`` windows (some 40 bytes
and a word each) is split into parts that fit, an item of more than that too, and each part is a pass that adds
its hits to those written by the pass before. Documents are cut once, after the last part, so the bound never
changes a result.

Defined cases
    null or empty text: no words, nothing hit. Null ids stay null. Repeated rows are scanned each by itself. A text
    of any length is scanned whole, in linear time. An item without words has no window; the windows of an item
    without an id hit words, but it isn't among the items listed. Ties: a window of several items counts for each,
    items with one id are one. An empty benchmark marks nothing, an empty table gives an empty result. Other
    columns, whatever their names, are ignored by ``scan`` and passed through unchanged by ``decontaminate``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .scratch import Scratch, small_batches

SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
ITEMS = pa.list_(pa.string())
ITEM_ROWS = 200_000
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class _Windows:
    """Distinct windows of one size: hashes in order, their places in the text, and the items that have them."""

    def __init__(self, size: int, text: bytes, values: np.ndarray, start: np.ndarray, end: np.ndarray, item: np.ndarray):
        order = np.argsort(values, kind="stable")
        same = np.concatenate([[False], values[order][1:] == values[order][:-1]])
        of = lambda k: text[start[k] : end[k]]
        other = [k for k in np.flatnonzero(same).tolist() if of(order[k]) != of(order[k - 1])]
        for k in sorted(set(values[order][other].tolist())):  # different windows with one hash
            low, high = np.searchsorted(values[order], np.uint64(k)), np.searchsorted(values[order], np.uint64(k), side="right")
            order[low:high] = sorted(order[low:high].tolist(), key=lambda x: (of(x), x))
            same[low + 1 : high] = [of(order[x]) == of(order[x - 1]) for x in range(low + 1, high)]
        head = np.flatnonzero(~same)
        self.size, self.values, self.start, self.end = size, values[order[head]], start[order[head]], end[order[head]]
        entry, held = np.cumsum(~same) - 1, item[order]
        fresh = np.concatenate([[True], (entry[1:] != entry[:-1]) | (held[1:] != held[:-1])])
        self.items, self.border = held[fresh].astype(np.int32), np.append(np.searchsorted(entry[fresh], np.arange(len(head))), int(fresh.sum()))
        self.sieve = np.zeros(1 << 20, dtype=bool)
        self.sieve[(self.values >> np.uint64(44)).astype(np.int64)] = True


class WindowSet:
    """Windows of benchmark items, ready for lookups."""

    def __init__(self, items: list[tuple[str | None, str | None]], length: int):
        raw, offsets = tk.flat(pa.array([text for _, text in items], type=pa.string()))
        words = tk.Words(raw, offsets, tk.ALNUM, True)
        text, _, start, end = words.joined_spans()
        self.names, self.text = [name for name, _ in items], tk.bytes_lower(text)
        sizes, self.windows = np.minimum(length, words.counts()), []
        for size in np.unique(sizes[sizes > 0]).tolist():
            values, at = words.grams(size)
            item = words.row_of(at)
            mine = sizes[item] == size
            values, at, item = values[mine], at[mine], item[mine]
            self.windows.append(_Windows(size, self.text, values, start[at], end[at + size - 1], item))

    def hits(self, words: tk.Words) -> Iterator[tuple[int, int, list[int]]]:
        """Verified (first word, number of words, items) of a block of rows."""
        for known in self.windows:
            found, at = words.grams(known.size)
            maybe = np.flatnonzero(known.sieve.take((found >> np.uint64(44)).astype(np.int64)))
            if not len(maybe):
                continue
            low = np.searchsorted(known.values, found[maybe])
            high = np.searchsorted(known.values, found[maybe], side="right")
            for k in np.flatnonzero(high > low).tolist():
                first = int(at[maybe[k]])
                text = words.text(first, first + known.size, True)
                for entry in range(int(low[k]), int(high[k])):
                    if self.text[known.start[entry] : known.end[entry]] == text:
                        yield first, known.size, known.items[known.border[entry] : known.border[entry + 1]].tolist()


def _runs(covered: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _scan_block(words: tk.Words, windows: WindowSet) -> tuple[np.ndarray, dict[int, set[int]]]:
    """Which words are hit, and the items by row."""
    covered = np.zeros(len(words) + 1, dtype=np.int32)
    items: dict[int, set[int]] = {}
    for low, size, holders in windows.hits(words):
        covered[low] += 1
        covered[low + size] -= 1
        items.setdefault(int(words.row_of(np.array([low]))[0]), set()).update(holders)
    return np.cumsum(covered[:-1]) > 0, items


def _item_parts(benchmark: DataFrame, item_col: str, text_col: str, length: int, bound: int) -> Iterator[WindowSet]:
    """Window sets of at most ``bound`` windows each, streamed to the driver item by item."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    part: list[tuple[str | None, str]] = []
    size = 0
    for row in rows.toLocalIterator(prefetchPartitions=False):
        for text in _pieces(row["text"], length, bound):
            most = len(text) // 2 + 1  # words, and so windows, that a text can have
            if part and (size + most > bound or len(part) >= ITEM_ROWS):
                yield WindowSet(part, length)
                part, size = [], 0
            part.append((row["item"], text))
            size += most
    if part:
        yield WindowSet(part, length)


def _pieces(text: str, length: int, bound: int) -> list[str]:
    """An item's text, in pieces that hold all its windows where it may have more than ``bound``."""
    if len(text) // 2 < bound or len(words := _WORD.findall(text)) <= length:
        return [text]
    step = max(1, bound // 8)
    return [" ".join(words[a : a + step + length - 1]) for a in range(0, len(words) - length + 1, step)]


SCAN, DROP, CUT = "scan", "drop", "cut"


def _pass(rows: DataFrame, windows: WindowSet, place: int, action: str, last: bool) -> DataFrame:
    """One window set's pass over ``rows``, whose last two columns are the items and spans found so far; the last
    set's pass applies the action and leaves these columns out."""
    shared = rows.sparkSession.sparkContext.broadcast(windows)
    out = rows.schema if not last else rows.drop("items", "spans").schema
    if last and action == SCAN:
        out = "doc_id long, n_words long, items array<string>, spans array<struct<start:int,end:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for batch in batches:
            raw, offsets = tk.flat(batch.column(place).cast(pa.string()))
            for low, high in tk.blocks(offsets):
                part, border = batch.slice(low, high - low), offsets[low : high + 1] - offsets[low]
                words = tk.Words(raw[offsets[low] : offsets[high]], border, tk.ALNUM, True)
                covered, held = _scan_block(words, windows)
                if action == DROP:
                    part = part.filter(pa.array(~np.isin(np.arange(high - low), list(held)))) if held else part
                    yield part.select(part.schema.names[:-2]) if last else part
                    continue
                items, spans, first = part.column(part.num_columns - 2).to_pylist(), part.column(part.num_columns - 1).to_pylist(), words.first.tolist()
                for row, found in held.items():
                    mine = covered[first[row] : first[row + 1]]
                    for span in spans[row]:
                        mine[span["start"] : span["end"]] = True
                    items[row] = sorted({*items[row], *(windows.names[x] for x in found if windows.names[x] is not None)})
                    spans[row] = [{"start": a, "end": b} for a, b in _runs(mine)]
                if last and action == CUT:
                    texts = part.column(place).to_pylist()
                    for row, found in enumerate(spans):
                        if found:
                            texts[row] = _cut(words, found, row, border.tolist())
                    part = part.set_column(place, part.schema.field(place), pa.array(texts, type=part.schema.field(place).type))
                    yield part.select(part.schema.names[:-2])
                elif last:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words.counts(), pa.int64()), pa.array(items, type=ITEMS), pa.array(spans, type=SPANS)], names=["doc_id", "n_words", "items", "spans"])
                else:
                    yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(items, type=ITEMS), pa.array(spans, type=SPANS)], names=part.schema.names)

    return rows.mapInArrow(run, out)


def _passes(rows: DataFrame, place: int, parts: Iterator[WindowSet], action: str, length: int) -> DataFrame:
    """All parts' passes, with a written table between two, so that a task holds one set at a time."""
    small_batches(rows.sparkSession)
    names = rows.columns
    rows = rows.toDF(*(f"c{k}" for k in range(len(names))))  # so that no name clashes
    rows = rows.withColumn("items", F.expr("cast(array() as array<string>)")).withColumn("spans", F.expr("cast(array() as array<struct<start:int,end:int>>)"))
    part, scratch, number = next(parts, WindowSet([], length)), None, 0
    while following := next(parts, None):
        scratch = scratch or Scratch(rows.sparkSession)
        rows = scratch.table(_pass(rows, part, place, action, False), f"hits{number}")
        if number:
            scratch.drop(f"hits{number - 1}")
        part, number = following, number + 1
    rows = _pass(rows, part, place, action, True)
    return rows if action == SCAN else rows.toDF(*names)


def scan(documents: DataFrame, benchmark: DataFrame, *, length: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_broadcast_windows: int = 4_000_000) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (names in string order) and spans of hit words (end exclusive)."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    hits = _passes(rows, 1, _item_parts(benchmark, item_col, item_text_col, length, max_broadcast_windows), SCAN, length)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + (x["end"] - x["start"]))
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), "items", "spans")


def decontaminate(documents: DataFrame, benchmark: DataFrame, *, action: str = DROP, length: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", max_broadcast_windows: int = 4_000_000) -> DataFrame:
    """Documents with all their columns, without contaminated ones (``drop``) or without the hit words (``cut``)."""
    if action not in (DROP, CUT):
        raise ValueError(f"action is drop or cut, not {action!r}")
    return _passes(documents, documents.columns.index(text_col), _item_parts(benchmark, item_col, item_text_col, length, max_broadcast_windows), action, length)


def _cut(words: tk.Words, spans: list[dict], row: int, offsets: list[int]) -> str:
    """A row's text without its hit words; what stands between kept words stays."""
    first, kept, at = int(words.first[row]), [], offsets[row]
    for span in spans:
        kept.append(words.raw[at : words.start[first + span["start"]]].tobytes())
        at = int(words.end[first + span["end"] - 1])
    return b"".join([*kept, words.raw[at : offsets[row + 1]].tobytes()]).decode("utf-8", "replace")
