"""N-gram Jaccard self-join with adaptive multi-match prefixes (after Wang, Li and Feng, 2012).

A document is the set of its distinct word shingles, ordered by estimated frequency and hash. If two sets
overlap enough to link, then for every m their prefixes of length ``n - least overlap + m`` share m shingles.
Each document picks its own m by estimated cost: frequent shingles in the prefix mean many candidates, and a
longer prefix that must be met m times has fewer. A pair is verified when the prefixes share as many shingles
as the smaller m of the two.

Shingles travel as 64-bit hashes, which only pick candidates. A link counts shingles whose words are equal. A class
of equal sets is keyed by a hash; where one key has several word sequences, their sets are compared by the words
themselves, and a set that isn't that of its key gets a key of its own.

Scale
    * One class of equal sets acts as one document, so copies cost one entry a task.
    * Prefix shingles travel packed, by hash range; those of a single class end there. Shingles known to be
      very frequent are spread by document instead, so no task holds such a list.
    * Every set has a bitmap of its hashes (after Sandes, Teodoro and Melo, 2020). Bits that one of a pair has
      alone bound the overlap from above, and only pairs that pass this bound have their texts fetched.
    * Joins with a class, shingle or component that many rows have are cut into parts (see ``hot``).
    * Every class is first linked with the most central class that it meets (a star). The full candidate
      search then leaves out pairs that are connected already: a large group of near copies costs its size,
      not its square, and no link between different components is lost. ``link_pairs`` and ``link_counts`` do
      form every pair: their cost is that of all links.
    * Estimated frequencies come from all documents: shingles found twice or more in a run of 2**21 of one
      task. They only order the prefixes, so the table is bounded (``HEAVY`` entries) without touching results.

Defined cases
    null or empty text: an empty set, linked with nothing. Fewer words than a shingle: the whole sequence is
    the one shingle. A text of any length is taken whole. A null id is linked with nothing and has no component.
    Repeated rows belong to one class. Ties between equally central classes: the greater key, which changes no
    result. An empty table gives an empty result. Other columns are ignored. ``n_shingles`` counts distinct 64-bit
    hashes within one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import meeting
from . import textkit as tk
from .components import connect
from .hot import heavy_keys, spread_join
from .scratch import Scratch, small_batches
from .texts import chosen, keyed, parted, sifted

HEAVY = 1 << 20
SPREAD = 20_000
MOST_MATCHES = 8
#: Shingles that a task counts at a time, and prefix entries that it sends at a time.
RUN, SEND = 1 << 21, 1 << 19
#: Cost of comparing one shingle of a candidate, with reading one entry of a list as 1.
COMPARE = 0.25

_STATS = "kind int, doc_id long, th long, n long, key long, guard binary, bits binary, hashes binary, counts binary"


def shingles(words: tk.Words, size: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Hashes of every row's shingles, not yet distinct, their first words, and the borders of the rows."""
    counts = words.counts()
    values, at = words.grams(size)
    if not (short := np.flatnonzero((counts > 0) & (counts < size))).size:
        return values, at, np.searchsorted(at, words.first).tolist()
    parts, places = [values], [at]
    for length in np.unique(counts[short]).tolist():
        more, where = words.grams(length)
        mine = np.isin(where, words.first[:-1][counts == length])
        parts.append(more[mine])
        places.append(where[mine])
    places = np.concatenate(places)
    order = np.argsort(places, kind="stable")
    return np.concatenate(parts)[order], places[order], np.searchsorted(places[order], words.first).tolist()


def _blocks(column: pa.Array) -> Iterator[tuple[int, int, tk.Words]]:
    """(first row, end, words) of the blocks of a batch of texts."""
    raw, offsets = tk.flat(column)
    for low, high in tk.blocks(offsets):
        yield low, high, tk.Words(raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], tk.SPACED, True)


def _rows(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """(row, ordered distinct shingles, lower-case words joined by one space) of a batch of texts."""
    for low, high, words in _blocks(batch.column("text")):
        values, _, border = shingles(words, size)
        text, ends = words.joined()
        text = tk.bytes_lower(text)
        for row in range(high - low):
            yield low + row, np.unique(values[border[row] : border[row + 1]]), text[ends[row] : ends[row + 1]]


def _key(values: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def _guard(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def _exact(text: bytes, size: int) -> bytes:
    """Digest of a set's shingles as words."""
    words = text.split(b" ")
    held = {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}
    return hashlib.blake2b(b"\n".join(sorted(held)), digest_size=16).digest()


def bitmap(values: np.ndarray) -> bytes:
    """At least four bits a hash, a power of two of them; a hash sets the bit of its low end."""
    size = 1 << max(6, int(4 * len(values) - 1).bit_length())
    held = np.zeros(size, dtype=bool)
    held[(values & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(held).tobytes()


def most_shared(n: int, a: bytes, m: int, b: bytes) -> int:
    """An upper bound of the overlap of two sets of n and m hashes with these bitmaps."""
    a, b = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    if len(a) != len(b):
        size = min(len(a), len(b))
        a, b = (np.bitwise_or.reduce(x.reshape(-1, size), axis=0) for x in (a, b))
    return min(n - int(np.bitwise_count(a & ~b).sum()), m - int(np.bitwise_count(b & ~a).sum()))


def _stats(size: int):
    schema = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("th", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("guard", pa.binary()), ("bits", pa.binary()), ("hashes", pa.binary()), ("counts", pa.binary())])

    def often(run: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        values, counts = np.unique(np.concatenate(run), return_counts=True)
        held = counts > 1
        if held.any():
            yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), *(pa.nulls(1, f.type) for f in list(schema)[1:7]), pa.array([values[held].tobytes()], pa.binary()), pa.array([counts[held].astype(np.int64).tobytes()], pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, waiting, here = [], 0, set()
        for batch in batches:
            n, key, guard, bits = [], [], [], []
            for _, values, text in _rows(batch, size):
                n.append(len(values))
                mine = _key(values) if len(values) else None
                key.append(mine)
                guard.append(_guard(text) if len(values) else None)
                bits.append(bitmap(values))
                if len(values) and mine not in here:
                    here.add(mine)
                    pending.append(values)
                    waiting += len(values)
                    if waiting >= RUN:
                        yield from often(pending)
                        pending, waiting, here = [], 0, set()
            rows = len(n)
            yield pa.RecordBatch.from_arrays([pa.array([0] * rows, pa.int32()), batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(key, pa.int64()), pa.array(guard, pa.binary()), pa.array(bits, pa.binary()), pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.binary())], schema=schema)
        if pending:
            yield from often(pending)

    return run


def _spread_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for hashes, counts in zip(batch.column("hashes"), batch.column("counts"), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(hashes.as_buffer(), dtype=np.int64)), pa.array(np.frombuffer(counts.as_buffer(), dtype=np.int64))], names=["h", "c"])


def _frequent(scan: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles and their estimated frequencies, at most about HEAVY of them."""
    counts = scan.where("kind = 1").select("hashes", "counts").mapInArrow(_spread_counts, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).withColumn("level", F.floor(4 * F.log2("c")).cast("int"))
    left, whole, part = HEAVY, 1 << 20, 0.0
    for row in counts.groupBy("level").count().orderBy(F.desc("level")).collect():  # at most 4 rows a power of two
        if row["count"] > left:
            whole, part = row["level"], left / row["count"]
            break
        left -= row["count"]
        whole, part = row["level"], 1.0
    picked = counts.where(F.col("level") > whole) if part < 1 else counts.where(F.col("level") >= whole)
    if 0 < part < 1:  # of equal ones, a share by hash
        picked = picked.unionByName(counts.where((F.col("level") == whole) & (F.pmod("h", F.lit(1 << 20)) < int(part * (1 << 20)))))
    table = picked.select("h", "c").toArrow()
    values = table.column("h").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], table.column("c").to_numpy().astype(np.int64)[order]


def prefix(values: np.ndarray, df: np.ndarray, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, int]:
    """Prefix of a set whose shingles have estimated frequencies ``df``, these, and the matches asked for."""
    n = len(values)
    least = -(-share[0] * n // share[1])
    if df.max(initial=1) == 1:
        size = n - least + 1
        return values[:size], df[:size], 1
    order = np.lexsort((values, df))
    reading = np.cumsum(df[order])
    matches = np.arange(1, min(MOST_MATCHES, least) + 1)
    size = n - least + matches
    candidates = (reading[size - 1] - size) / matches
    best = int(np.argmin(reading[size - 1] + COMPARE * n * candidates))
    picked = order[: size[best]]
    return values[picked], df[picked], int(matches[best])


_SENT = "bucket long, hashes binary, keys binary, meta binary"
_POSTINGS = "h long, key long, n int, m int, place int"


def _send(size: int, share: tuple[int, int], bits: int, frequent, moved):
    def out(held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        bucket, hashes, keys, meta = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(bucket, kind="stable")
        bucket, hashes, keys, meta = bucket[order], hashes[order], keys[order], meta[order]
        border = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])).tolist()
        cuts = list(zip(border, border[1:], strict=False))
        yield pa.RecordBatch.from_arrays([pa.array([int(bucket[a]) for a, _ in cuts], pa.int64()), *(pa.array([x[a:b].tobytes() for a, b in cuts], pa.binary()) for x in (hashes, keys, meta))], names=["bucket", "hashes", "keys", "meta"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (heavy, counts), other = frequent.value, moved.value
        held, waiting, here = [], 0, set()
        for batch in batches:
            null = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            for row, values, text in _rows(batch, size):
                if null[row] or not len(values):
                    continue
                key = _key(values)
                if key in other:
                    key = other[key].get(_guard(text), key)
                if key in here:
                    continue
                here.add(key)
                df = np.ones(len(values), dtype=np.int64)
                if len(heavy):
                    place = np.minimum(np.searchsorted(heavy, values), len(heavy) - 1)
                    df = np.where(heavy[place] == values, counts[place], 1)
                chosen_, often, matches = prefix(values, df, share)
                wide = often >= SPREAD
                where = np.where(wide, tk.mix(chosen_ ^ np.uint64(key & (2**64 - 1))), chosen_) >> np.uint64(64 - bits)
                held.append((where.astype(np.int64), chosen_, np.full(len(chosen_), key, dtype=np.int64), wide.astype(np.int64) << 62 | np.arange(len(chosen_), dtype=np.int64) << 34 | len(values) << 6 | matches))
                waiting += len(chosen_)
                if waiting >= SEND:
                    yield from out(held)
                    held, waiting = [], 0
        if held:
            yield from out(held)

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that classes share, one row per shingle and class; spread ones pass."""
    held = [[], [], []]
    for batch in batches:
        for parts, name in zip(held, ("hashes", "keys", "meta"), strict=True):
            parts += [np.frombuffer(x.as_buffer(), dtype=np.int64) for x in batch.column(name)]
    if not held[0]:
        return
    hashes, keys, meta = (np.concatenate(x) for x in held)
    del held
    order = np.lexsort((keys, hashes))
    hashes, keys, meta = hashes[order], keys[order], meta[order]
    fresh = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (keys[1:] != keys[:-1])])
    hashes, keys, meta = hashes[fresh], keys[fresh], meta[fresh]
    same = hashes[1:] == hashes[:-1]
    keep = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]) | (meta >> 62 > 0))
    for at in range(0, len(keep), 1 << 16):
        part = keep[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(hashes[part]), pa.array(keys[part]), pa.array((meta[part] >> 6 & 0xFFFFFFF).astype(np.int32)), pa.array((meta[part] & 0x3F).astype(np.int32)), pa.array((meta[part] >> 34 & 0xFFFFFFF).astype(np.int32))], names=["h", "key", "n", "m", "place"])


def _joined(column: pa.Array) -> Iterator[bytes]:
    """Texts as lower-case words joined by one space."""
    for _, _, words in _blocks(column):
        text, ends = words.joined()
        text = tk.bytes_lower(text)
        yield from (text[a:b] for a, b in zip(ends, ends[1:], strict=False))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(list(_joined(batch.column("text"))), pa.binary())], names=["key", "words"])


def _exact_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            exact = [_exact(x, size) for x in _joined(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("guard"), pa.array(exact, pa.binary())], names=["key", "guard", "exact"])

    return run


def _possible(share: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for n, left, m, right in zip(batch.column("n").to_pylist(), batch.column("left").to_pylist(), batch.column("m").to_pylist(), batch.column("right").to_pylist(), strict=True):
                both = most_shared(n, left, m, right)
                held.append(share[1] * both >= share[0] * (n + m - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(held, pa.bool_()))

    return run


class _Held:
    """Sets of some texts, by key: hashes in order, and where in the text each shingle stands."""

    def __init__(self, texts: dict[int, bytes], size: int):
        raw = np.frombuffer(b"".join(texts.values()), dtype=np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts.values()])]).astype(np.int64)
        words = tk.Words(raw, offsets, tk.SPACED, False)
        values, at, border = shingles(words, size)
        last = np.minimum(at + size, words.first[1:][words.row_of(at)]) - 1
        start, end = words.start[at], words.end[last]
        self.sets = {}
        for row, (key, text) in enumerate(texts.items()):
            part = slice(border[row], border[row + 1])
            found, first = np.unique(values[part], return_index=True)
            self.sets[key] = found, start[part][first] - offsets[row], end[part][first] - offsets[row], text

    def links(self, a: int, b: int, share: tuple[int, int]) -> bool:
        """Do the two sets link, by shingles whose words are equal?"""
        (x, x_start, x_end, x_text), (y, y_start, y_end, y_text) = self.sets[a], self.sets[b]
        fits = lambda both: share[1] * both >= share[0] * (len(x) + len(y) - both)
        _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
        if not fits(len(i)):
            return False
        spans = zip(x_start[i].tolist(), x_end[i].tolist(), y_start[j].tolist(), y_end[j].tolist(), strict=True)
        return fits(sum(x_text[p:q] == y_text[r:s] for p, q, r, s in spans))


def _verify(size: int, share: tuple[int, int]):
    def judged(pairs: list[tuple[int, int]], texts: dict[int, bytes]) -> pa.RecordBatch:
        held = _Held(texts, size)
        good = [p for p in pairs if held.links(*p, share)]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in good], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, texts, waiting = [], {}, 0
            for a, b, left, right in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("left"), batch.column("right"), strict=True):
                pairs.append((a, b))
                for key, text in ((a, left), (b, right)):
                    if key not in texts:
                        texts[key] = text.as_py()
                        waiting += len(texts[key])
                if waiting > tk.BLOCK_BYTES:
                    yield judged(pairs, texts)
                    pairs, texts, waiting = [], {}, 0
            if pairs:
                yield judged(pairs, texts)

    return run


class _Join:
    """One run of the join."""

    def __init__(self, documents: DataFrame, size: int, share: tuple[int, int], id_col: str, text_col: str):
        self.spark, self.size, self.share = documents.sparkSession, size, share
        small_batches(self.spark)
        self.scratch = Scratch(self.spark)
        self.rows = keyed(documents, id_col, text_col)
        scan = self.scratch.table(self.rows.mapInArrow(_stats(size), _STATS), "scan")
        self.stats = scan.where("kind = 0").select("doc_id", "th", "n", "key", "guard", "bits")
        moved = self._moved(self._different("texts"))
        if moved:
            held = self.spark.createDataFrame([(k, g, to) for k, of in moved.items() for g, to in of.items()], "key long, guard binary, _to long")
            self.stats = self.stats.join(F.broadcast(held), ["key", "guard"], "left").withColumn("key", F.coalesce("_to", "key")).select("doc_id", "th", "n", "key", "guard", "bits")
        different = self._different("texts2") if moved else self.texts
        firsts = different.groupBy("key").agg(F.min(F.struct("doc_id", "th")).alias("first"), F.max("n").alias("n"))
        self.classes = self.scratch.table(firsts.select("key", "first.doc_id", "first.th", "n"), "classes")
        frequent, other = self.spark.sparkContext.broadcast(_frequent(scan)), self.spark.sparkContext.broadcast(moved)
        total = self.classes.agg(F.sum("n")).first()[0] or 0
        tasks = meeting.tasks_for(total * (share[1] - share[0]) // share[1])
        sent = self.rows.mapInArrow(_send(size, share, meeting.bits_for(tasks), frequent, other), _SENT)
        self.postings = self.scratch.table(sent.repartition(tasks, "bucket").mapInArrow(_meet, _POSTINGS), "postings")
        self.common = heavy_keys(self.postings, "h")

    def _different(self, name: str) -> DataFrame:
        """One row for each key and word sequence."""
        of = self.stats.where("key is not null and doc_id is not null").groupBy("key", "guard").agg(F.min(F.struct("doc_id", "th")).alias("first"), F.max("n").alias("n"))
        self.texts = self.scratch.table(of.select("key", "guard", "first.doc_id", "first.th", "n"), name)
        return self.texts

    def _moved(self, texts: DataFrame) -> dict[int, dict[bytes, int]]:
        """New keys of the sets that have another set's key, by key and word sequence: none, but for one pair in
        2**64, so that they go to the driver."""
        mixed = texts.groupBy("key").count().where("count > 1").select("key")
        mixed = self.scratch.table(texts.join(mixed, "key", "left_semi").drop("n"), "mixed")
        texts = chosen(self.rows, mixed).dropDuplicates(["key", "guard"]).select("key", "guard", "text")
        sets = self.scratch.table(texts.mapInArrow(_exact_sets(self.size), "key long, guard binary, exact binary"), "exact")
        wrong = sets.groupBy("key").agg(F.min("exact").alias("_first"), F.max("exact").alias("_last")).where("_first != _last").select("key", "_first")
        out: dict[int, dict[bytes, int]] = {}
        self.scratch.drop("mixed")
        for row in sets.join(wrong, "key").where("exact != _first").select("key", "guard", F.xxhash64("key", "exact").alias("to")).collect():
            out.setdefault(row["key"], {})[bytes(row["guard"])] = row["to"]
        return out

    def _fits(self, a: str, b: str, k: str | None = None) -> str:
        """Sizes that can link, and shingles early enough for it: two sets that link share at least
        ``ceil(low * (n + m) / (low + high))`` shingles, so the first k that they share stand among the first
        ``n - that + k`` of either; k is the lesser number of matches asked for, or the one given."""
        low, high = self.share
        least = f"cast(ceil({low}L * ({a}n + {b}n) / {low + high}.0D - 1e-9) as int)"
        k = k or f"least({a}m, {b}m)"
        sizes = f"least({a}n, {b}n) * {high}L >= greatest({a}n, {b}n) * {low}L"
        return f"{sizes} and {a}place < {a}n - {least} + {k} and {b}place < {b}n - {least} + {k}"

    def _sides(self, pairs: DataFrame, of: DataFrame, column: str, others: tuple[str, str]) -> DataFrame:
        """Pairs (a, b, ...) with the columns of either class, ``of`` (key, n, column); neither may be a hub."""
        for x, other, name, n in (("a", "b", others[0], "n"), ("b", "a", others[1], "m")):
            pairs = spread_join(pairs, of.select(F.col("key").alias(x), *([F.col("n").alias(n)] if "n" in of.columns else []), F.col(column).alias(name)), x, self.hubs[x], by=other)
        return pairs

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """Those pairs (a, b) of classes whose sets link."""
        pairs = self.scratch.table(pairs, f"{name}-met")
        self.hubs = {x: heavy_keys(pairs, x) for x in "ab"}
        nodes = self.scratch.table(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), f"{name}-nodes")
        maps = sifted(self.stats.where("doc_id is not null").select("key", "n", "bits"), nodes, "key").dropDuplicates(["key"])  # equal sets have equal maps
        sides = self._sides(pairs, maps, "bits", ("left", "right")).select("a", "b", "n", "left", "m", "right")
        pairs = self.scratch.table(sides.mapInArrow(_possible(self.share), "a long, b long"), f"{name}-pairs")
        for done in ("met", "nodes"):
            self.scratch.drop(f"{name}-{done}")
        nodes = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
        firsts = self.scratch.table(self.classes.join(nodes, "key", "left_semi").select("key", "doc_id", "th"), f"{name}-firsts")
        words = chosen(self.rows, firsts).dropDuplicates(["key"]).select("key", "text").mapInArrow(_texts, "key long, words binary")
        words = self.scratch.table(words, f"{name}-words")
        sides = self._sides(pairs, words, "words", ("left", "right")).select("a", "b", "left", "right")
        links = self.scratch.table(sides.mapInArrow(_verify(self.size, self.share), "a long, b long"), f"{name}-links")
        self.scratch.drop(f"{name}-words")
        return links

    def stars(self) -> DataFrame:
        """Each class with the most central of the classes whose prefix meets its own often enough, the one it shares
        most with."""
        shared = self.postings.groupBy("key").agg(F.count("*").alias("met"), F.first("n").alias("n"))
        centre = shared.select("key", (F.col("met") / F.col("n")).alias("central"))
        best = self.postings.join(centre.hint("merge"), "key").groupBy("h").agg(F.max(F.struct("central", "key", "n", "m", "place")).alias("best"))
        met = spread_join(self.postings, best, "h", self.common, by="key").where(f"key != best.key and {self._fits('', 'best.')}")
        each = met.groupBy("key", F.col("best.key").alias("centre"), F.col("best.central").alias("central")).agg(F.count("*").alias("count"), F.first(F.least("m", "best.m")).alias("asked"))
        return each.where("count >= asked").groupBy("key").agg(F.max(F.struct("count", "central", "centre")).alias("best")).select(F.col("key").alias("a"), F.col("best.centre").alias("b"))

    def _often_enough(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs (a, b, m) whose prefixes share m shingles at least."""
        pairs = self.scratch.table(pairs, f"{name}-first")
        held = self.postings.groupBy("key").agg(F.collect_list("h").alias("hs"))  # no longer than a document
        self.hubs = {x: heavy_keys(pairs, x) for x in "ab"}
        return self._sides(pairs, held, "hs", ("left", "right")).where("size(array_intersect(left, right)) >= m").select("a", "b")

    def across(self, roots: DataFrame) -> DataFrame:
        """All candidate pairs of classes that aren't connected yet."""
        placed = self.scratch.table(self.postings.join(roots.toDF("key", "root").hint("merge"), "key", "left").withColumn("root", F.coalesce("root", "key")), "rooted")
        self.scratch.drop("postings")
        self.postings = placed
        parts = placed.groupBy("h", "root").count().groupBy("h").agg(F.count("*").alias("parts"), F.max(F.struct("count", "root")).alias("main")).where("parts > 1").select("h", F.col("main.root").alias("main"))
        placed = self.scratch.table(spread_join(placed, parts, "h", self.common, by="key"), "placed")
        # one side of a pair is outside the list's main component, so pairs inside that are never formed
        left = placed.where("root != main").select("h", F.col("key").alias("x"), F.col("root").alias("x_root"), *(F.col(c).alias(f"x_{c}") for c in ("n", "m", "place")))
        right = placed.select("h", F.col("key").alias("y"), F.col("root").alias("y_root"), *(F.col(c).alias(f"y_{c}") for c in ("n", "m", "place")), "main")
        # the first shingle that a pair shares stands in either's prefix for one match, where the rare ones are ...
        met = spread_join(right, left, "h", self.common, by="y").where(f"x_root != y_root and (y_root = main or x < y) and {self._fits('x_', 'y_', '1')}")
        pairs = met.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.first(F.least("x_m", "y_m")).alias("m"))
        # ... and the whole prefixes must share as many as the match asks for
        return self._often_enough(pairs, "across")

    def met(self) -> DataFrame:
        """All candidate pairs of classes, connected or not."""
        left, right = (self.postings.select("h", F.col("key").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in ("n", "m", "place"))) for x in "xy")
        met = spread_join(right, left, "h", self.common, by="y").where(f"x < y and {self._fits('x_', 'y_', '1')}")
        pairs = met.groupBy(F.col("x").alias("a"), F.col("y").alias("b")).agg(F.first(F.least("x_m", "y_m")).alias("m"))
        return self._often_enough(pairs, "all")

    def all_links(self) -> DataFrame:
        """Every link (a, b) of different classes, a < b."""
        return self.verified(self.met(), "all")

    def links(self) -> DataFrame:
        """Links that connect all components of classes (a spanning part of all links)."""
        star = self.verified(self.stars(), "star")
        roots = connect(star).checkpoint()
        return star.unionByName(self.verified(self.across(roots), "across"))

    def components(self) -> DataFrame:
        """(key, root, component_id) of every class; root tells components apart that have the same least id."""
        roots = connect(self.links())
        joined = self.classes.select("key", "doc_id").join(roots.toDF("key", "root").hint("merge"), "key", "left").withColumn("root", F.coalesce("root", "key"))
        joined = self.scratch.table(joined, "joined")
        least = joined.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        return spread_join(joined.select("key", "root"), least, "root", heavy_keys(joined, "root"), by="key").select("key", "root", "component_id")

    def with_keys(self, of: DataFrame, *columns: str) -> DataFrame:
        """Documents' stats (doc_id, th, n, key and the columns named) joined with a table by key, where there is a row;
        copies of a text share a key."""
        stats = self.stats.select("doc_id", "th", "n", "key", *columns)
        return spread_join(stats, of, "key", heavy_keys(stats, "key"), "left", by="doc_id")


def link(documents: DataFrame, *, size: int = 5, share: tuple[int, int] = (75, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, th (hash of its text), n_shingles and component_id, the least id reachable by links."""
    join = _Join(documents, size, share, id_col, text_col)
    met = join.with_keys(join.components())
    alone = F.when(F.col("key").isNull(), F.col("doc_id"))
    return met.select("doc_id", "th", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", alone, "doc_id")).alias("component_id"))


def _copies(join: _Join) -> DataFrame:
    """(key, copies): the different documents (id and text) of every class."""
    held = join.stats.where("key is not null and doc_id is not null")
    return held.select("key", "doc_id", "th").distinct().groupBy("key").agg(F.count("*").alias("copies"))


def link_pairs(documents: DataFrame, *, size: int = 5, share: tuple[int, int] = (75, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every verified link between classes of different texts, once, by the least documents of the two classes:
    doc_a, th_a, doc_b, th_b, and the documents of either class, copies_a and copies_b."""
    join = _Join(documents, size, share, id_col, text_col)
    of = join.classes.select("key", "doc_id", "th").join(_copies(join), "key")
    sides = (of.select(F.col("key").alias(x), F.col("doc_id").alias(f"doc_{x}"), F.col("th").alias(f"th_{x}"), F.col("copies").alias(f"copies_{x}")) for x in "ab")
    met = join.all_links()
    for x, side in zip("ab", sides, strict=True):
        met = met.join(side, x)
    return met.drop("a", "b")


def link_counts(documents: DataFrame, *, size: int = 5, share: tuple[int, int] = (75, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, th, n_shingles, n_copies (other documents of its class) and n_links, all other
    documents it links with, copies among them. A document is an id and a text; a null id has null counts."""
    join = _Join(documents, size, share, id_col, text_col)
    copies, links = _copies(join), join.all_links()
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = ends.join(copies.toDF("b", "copies"), "b").groupBy(F.col("a").alias("key")).agg(F.sum("copies").alias("near"))
    of = copies.join(near, "key", "left").select("key", (F.col("copies") - 1).alias("same"), F.coalesce("near", F.lit(0)).alias("near"))
    met = join.with_keys(of)
    counted = lambda c: F.when(F.col("doc_id").isNotNull(), F.coalesce(c, F.lit(0)).cast("long"))
    return met.select("doc_id", "th", F.col("n").alias("n_shingles"), counted(F.col("same")).alias("n_copies"), counted(F.col("same") + F.col("near")).alias("n_links"))


def keep_one(documents: DataFrame, *, size: int = 5, share: tuple[int, int] = (75, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with all their columns, one row of each component: that of the least id, then text hash, then one
    of equal rows. Rows without words stay; rows without an id are one group for each sequence of words."""
    join = _Join(documents, size, share, id_col, text_col)
    none = F.col("doc_id").isNull()
    group = F.when(none, F.hex("guard")).otherwise(F.hex("root"))
    rows = join.with_keys(join.components().select("key", "root"), "guard").where("key is not null")
    rows = join.scratch.table(rows.groupBy("doc_id", "th", group.alias("group")).agg(F.count("*").alias("rows")), "rows")
    first = rows.groupBy("group", none.alias("none")).agg(F.min(F.struct("doc_id", "th")).alias("first")).select(F.struct("group", "none").alias("group"), "first")
    dealt = rows.select("doc_id", "th", "rows", F.struct("group", none.alias("none")).alias("group"))
    judged = spread_join(dealt, first, "group", heavy_keys(dealt, "group")).withColumn("kept", F.struct("doc_id", "th").eqNullSafe(F.col("first")))
    judged = join.scratch.table(judged.where("not kept or rows > 1").select(F.col("doc_id").alias("__id"), F.col("th").alias("__hash"), "kept"), "judged")
    gone, several = judged.where("not kept").drop("kept"), judged.where("kept").drop("kept")
    mark = documents.select("*", F.col(id_col).cast("long").alias("__me"), F.xxhash64(F.col(text_col).cast("string")).alias("__mine"))
    same = F.col("__me").eqNullSafe(F.col("__id")) & (F.col("__mine") == F.col("__hash"))
    mark, rest = parted(mark, judged.select(F.col("__id").alias("__me")), "__me")  # the others' texts stay where they are
    left = mark.join(gone, same, "left_anti")
    if several.limit(1).count():  # only the rows that repeat a kept one are dealt by id and text
        left = left.join(several, same, "left_anti").unionByName(left.join(several, same, "left_semi").dropDuplicates(["__me", "__mine"]))
    return (left if rest is None else left.unionByName(rest)).drop("__me", "__mine")
