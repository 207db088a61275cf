"""Length buckets of least padding, and token-budget batches inside each bucket.

A text is cut into pieces of at most ``max_length`` tokens. The global histogram of piece lengths has at most
``max_length`` rows, so it goes to the driver, where dynamic programming chooses the bucket borders: bucket
(a, b] pads its pieces to the longest of them, and the sum of all padding is least. Batches then fill up, in
order of a hash of the id, with as many pieces as the token budget holds at the bucket's length.

A bucket may hold a third of all pieces, so each is dealt to groups of about ``GROUP`` pieces by that hash, or of
``GROUP_TOKENS`` tokens if these are fewer; a group numbers its own pieces and starts its own batches. Ids and lengths
are shuffled, and with ``texts`` each piece's own text, once, so that a batch's pieces come together.

Tokens are words at white space unless ``vocabulary`` names the path of a ``tokenizers`` JSON file that the
executors can read; its ids are then counted.

Defined cases
    null or empty text, or one without a token: no piece, no row, unless ``keep_empty``, which gives one piece
    of length 0 in the first bucket. A text of any length is cut into as many pieces as it takes. Null ids and
    repeated rows are packed like others. Ties in cost: the lower border. An empty table gives an empty result.
    Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .scratch import Scratch, small_batches

GROUP, GROUP_TOKENS = 50_000, 8_000_000


def borders(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper borders, at most ``buckets`` of the ordered lengths, with the least padding in all.

    With S and T the running sums of counts and of counts times lengths, bucket (i, j] costs
    ``length[j] * (S[j] - S[i]) - (T[j] - T[i])``. Best split points never move down as j grows, so each
    further bucket takes a divide and conquer over j: n log n a bucket.
    """
    n = len(lengths)
    if not n:
        return []
    s = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    t = np.concatenate([[0], np.cumsum(counts.astype(np.int64) * lengths)]).astype(np.int64)
    best = lengths * s[1:] - t[1:]  # one bucket for the first j + 1 lengths
    best = np.concatenate([[0], best])
    choice = []
    for _ in range(1, min(buckets, n)):
        now, cut = best.copy(), np.zeros(n + 1, dtype=np.int64)
        cut[:] = -1
        stack = [(1, n, 0, n - 1)]
        while stack:
            low, high, first, last = stack.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            cost = best[i] + lengths[j - 1] * (s[j] - s[i]) - (t[j] - t[i])
            at = int(np.argmin(cost))
            now[j], cut[j] = cost[at], i[at]
            stack += [(low, j - 1, first, int(i[at])), (j + 1, high, int(i[at]), last)]
        choice.append(cut)
        best = now
    out, j = [], n
    for cut in reversed(choice):
        if j == 0:
            break
        out.append(int(lengths[j - 1]))
        j = int(cut[j])
    if j > 0:
        out.append(int(lengths[j - 1]))
    return sorted(set(out))


def _counter(vocabulary: str | None):
    if vocabulary is None:
        def words(column: pa.Array) -> np.ndarray:
            raw, offsets = tk.flat(column)
            parts = [np.zeros(0, dtype=np.int64)]
            for low, high in tk.blocks(offsets):
                parts.append(tk.count_words(raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], tk.SPACED))
            return np.concatenate(parts)

        return words
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True
    return lambda column: np.array([len(x.ids) for x in tokenizer.encode_batch([t or "" for t in column.to_pylist()], add_special_tokens=False)], dtype=np.int64)


def _ends(vocabulary: str | None):
    """What gives, for a text, the bytes where its tokens begin and end."""
    if vocabulary is None:
        def words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
            inside = np.concatenate([[False], tk.SPACED.take(np.frombuffer(text, dtype=np.uint8)), [False]])
            edge = np.flatnonzero(inside[1:] != inside[:-1])
            return edge[::2], edge[1::2]

        return words
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True

    def tokens(text: bytes) -> tuple[np.ndarray, np.ndarray]:
        plain = text.decode()
        spans = np.array(tokenizer.encode(plain, add_special_tokens=False).offsets, dtype=np.int64).reshape(-1, 2)
        size = np.concatenate([[0], np.cumsum([len(c.encode()) for c in plain])]).astype(np.int64)
        return size[spans[:, 0]], size[spans[:, 1]]

    return tokens


def _cut(column: pa.Array, pieces: np.ndarray, max_length: int, ends) -> list[str]:
    """The text of each piece: from its first token to its last; a text that is one piece stays as it is."""
    out = []
    for text, n in zip(column, pieces.tolist(), strict=True):
        if n == 1:
            out.append(text.as_py() or "")
        elif n > 1:
            raw = text.as_py().encode()
            start, end = ends(raw)
            last = np.minimum(np.arange(1, n + 1) * max_length, len(end)) - 1
            out += [raw[a:b].decode("utf-8", "replace") for a, b in zip(start[::max_length].tolist(), end[last].tolist(), strict=True)]
    return out


def _pieces(max_length: int, vocabulary: str | None, keep_empty: bool, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(vocabulary)
        ends = _ends(vocabulary) if texts else None
        for batch in batches:
            tokens = count(batch.column("text"))
            pieces = np.maximum(-(-tokens // max_length), 1 if keep_empty else 0)
            row = np.repeat(np.arange(len(tokens)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            length = np.minimum(tokens[row] - piece * max_length, max_length)
            out = [batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(piece * max_length), pa.array(length.astype(np.int32))]
            if texts:
                out.append(pa.array(_cut(batch.column("text"), pieces, max_length, ends), pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "piece", "start", "n_tokens", "text"][: len(out)])

    return run


def pack(documents: DataFrame, *, buckets: int = 16, max_length: int = 2048, budget: int = 32_768, vocabulary: str | None = None, keep_empty: bool = False, texts: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start (its first token), n_tokens, bucket_len (the length it is padded
    to), batch (a name that no other batch has) and slot (its row in the batch); with ``texts`` also its text."""
    if max_length > budget:
        raise ValueError("one piece must fit the token budget")
    spark = documents.sparkSession
    small_batches(spark)
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = Scratch(spark).table(rows.mapInArrow(_pieces(max_length, vocabulary, keep_empty, texts), "doc_id long, piece int, start long, n_tokens int" + ", text string" * texts), "pieces")
    histogram = sorted((r["n_tokens"], r["count"]) for r in pieces.groupBy("n_tokens").count().collect())  # max_length + 1 rows at most
    lengths, counts = np.array([x for x, _ in histogram], dtype=np.int64), np.array([x for _, x in histogram], dtype=np.int64)
    tops = borders(lengths, counts, buckets)
    bucket = F.lit(None).cast("int")
    groups = F.lit(1)
    for top in reversed(tops):
        low = max([x for x in tops if x < top], default=-1)
        held = int(counts[(lengths > low) & (lengths <= top)].sum())
        bucket = F.when(F.col("n_tokens") <= top, F.lit(top)).otherwise(bucket)
        groups = F.when(F.col("n_tokens") <= top, F.lit(math.ceil(max(held / GROUP, held * top / GROUP_TOKENS)))).otherwise(groups)
    dealt = pieces.withColumn("bucket_len", bucket).withColumn("_place", F.xxhash64("doc_id", "piece")).withColumn("group", F.pmod("_place", groups).cast("int"))
    order = Window.partitionBy("bucket_len", "group").orderBy("_place", "doc_id", "piece")
    number = F.row_number().over(order) - 1
    size = F.floor(F.lit(budget) / F.greatest("bucket_len", F.lit(1))).cast("int")
    numbered = dealt.withColumn("_number", number).withColumn("_size", size)
    name = F.concat_ws("-", F.col("bucket_len").cast("string"), F.col("group").cast("string"), F.floor(F.col("_number") / F.col("_size")).cast("string"))
    return numbered.select("doc_id", "piece", "start", "n_tokens", "bucket_len", name.alias("batch"), F.pmod("_number", "_size").alias("slot"), *(["text"] * texts))
