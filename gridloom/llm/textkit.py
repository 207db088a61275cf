"""Vectorised text primitives on Arrow buffers: words, 64-bit word hashes and hashes of word windows.

Texts stay UTF-8 bytes in one flat buffer; word borders, hashes and windows are numpy expressions over
that buffer, so no Python object is made per word. Blocks bound the working memory.

A word's hash mixes each eight of its bytes before it adds them up, so no pattern of letters cancels out as it
does in polynomials modulo 2**64. Equal hashes are still no proof of equal words: whoever needs that compares
the words, or digests of them (``window_digests``).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK_BYTES = 1 << 18
U64 = np.uint64


def _class(separators: set[int]) -> np.ndarray:
    kind = np.ones(256, dtype=bool)
    kind[list(separators)] = False
    return kind


#: Bytes of words split at ASCII white space.
SPACED = _class({0x20, *range(0x09, 0x0E)})
#: Bytes of words made of ASCII letters, digits and anything beyond ASCII.
ALNUM = _class({*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)} - set(range(0x41, 0x5B)))

_STEP = U64(0x9E3779B97F4A7C15)
_WORD_STEP = U64(0xD1342543DE82EF95)
_SALT = U64(0x2545F4914F6CDD1D)
#: The first k bytes of a little-endian long.
_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] = np.arange(0x61, 0x7B)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class _Powers:
    """Powers of an odd factor modulo 2**64, grown on demand."""

    def __init__(self, factor: U64):
        self.factor = factor
        self.values = np.ones(1, dtype=U64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            size = 1 << max(10, int(n - 1).bit_length())
            self.values = np.cumprod(np.concatenate([np.ones(1, dtype=U64), np.full(size - 1, self.factor, dtype=U64)]), dtype=U64)
        return self.values[:n]


_word_powers = _Powers(_WORD_STEP)
_word_inverse = _Powers(U64(pow(int(_WORD_STEP), -1, 2**64)))


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words raw[start:end]; one eight of bytes for most, more for longer words."""
    padded = np.zeros(len(raw) + 8, dtype=np.uint8)
    padded[: len(raw)] = raw
    eights = np.ndarray((len(raw) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    length = end - start
    sums = mix((eights[start] & _BYTES[np.minimum(length, 8)]) ^ _SALT)
    if (wide := np.flatnonzero(length > 8)).size:
        more = (length[wide] - 1) >> 3
        border = np.cumsum(more) - more
        place = np.arange(int(more.sum())) - np.repeat(border, more) + 1
        at, left = np.repeat(start[wide], more) + 8 * place, np.repeat(length[wide], more) - 8 * place
        parts = mix((eights[at] & _BYTES[np.minimum(left, 8)]) ^ _SALT)
        parts *= mix(place.astype(U64) * _STEP) | U64(1)
        sums[wide] += np.add.reduceat(parts, border)
    return mix(sums + length.astype(U64) * _STEP)


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32, count=len(column) + column.offset + 1)[column.offset :].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes, one row at least."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


class Words:
    """Words of a block of rows.

    ``start`` and ``end`` are byte positions in ``raw``, ``first`` has for each row the index of its first
    word (n + 1 entries), ``hash`` a 64-bit hash per word.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray, lower: bool):
        self.raw = raw
        rows = len(offsets) - 1
        if not len(raw):
            self.start = self.end = np.zeros(0, dtype=np.int64)
            self.first = np.zeros(rows + 1, dtype=np.int64)
            self.hash = np.zeros(0, dtype=U64)
            self.inside, self.offsets = np.zeros(0, dtype=bool), offsets
            return
        inside = kind.take(raw)
        self.inside, self.offsets = inside, offsets
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        heads = offsets[:-1][offsets[:-1] < len(raw)]
        first[heads] = inside[heads]
        tails = offsets[1:][offsets[1:] > 0] - 1
        last[tails] = inside[tails]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, offsets)
        if not len(self.start):
            self.hash = np.zeros(0, dtype=U64)
            return
        self.hash = word_hashes(_LOWER.take(raw) if lower else raw, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``length`` words that stay in one row, and the index of their first word."""
        n = len(self.hash)
        if n < length:
            return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
        sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(self.hash * _word_powers.upto(n), out=sums[1:])
        value = (sums[length:] - sums[:-length]) * _word_inverse.upto(n)[: n - length + 1]
        fits = np.ones(n, dtype=bool)
        if length > 1:
            for low, high in zip(np.maximum(self.first[1:] - length + 1, self.first[:-1]).tolist(), self.first[1:].tolist(), strict=True):
                fits[low:high] = False
        at = np.flatnonzero(fits[: n - length + 1])
        return mix(value[at] + U64(length * int(_STEP) % 2**64)), at

    def row_of(self, at: np.ndarray) -> np.ndarray:
        """Row of each word index."""
        return np.searchsorted(self.first, at, side="right") - 1

    def joined(self) -> tuple[bytes, list[int]]:
        """All rows' words joined by one space each, as one buffer, and the borders of the rows in it."""
        rows = len(self.first) - 1
        if not len(self.start):
            return b"", [0] * (rows + 1)
        inner = np.ones(len(self.start), dtype=bool)
        inner[self.first[1:][self.first[1:] > self.first[:-1]] - 1] = False
        keep = self.inside.copy()
        keep[self.end[inner]] = True
        value = np.where(self.inside, self.raw, np.uint8(0x20))[keep]
        size = np.concatenate([[0], np.cumsum(keep)])
        return value.tobytes(), size[self.offsets].tolist()

    def joined_spans(self) -> tuple[bytes, list[int], np.ndarray, np.ndarray]:
        """``joined`` with the borders of every word in it."""
        text, border = self.joined()
        length = self.end - self.start
        start = np.cumsum(length) - length
        if len(start):  # one space between words of a row, none between rows
            counts = self.counts()
            spaces = np.arange(len(start)) - np.repeat(np.cumsum(counts > 0) - 1, counts)
            start = start + spaces
        return text, border, start, start + length

    def text(self, low: int, high: int, lower: bool = False) -> bytes:
        """Words low..high-1 joined by one space."""
        raw = self.raw.tobytes() if high - low > 10_000 else None
        if raw is None:
            base = int(self.start[low]) if high > low else 0
            raw = self.raw[base : int(self.end[high - 1]) if high > low else 0].tobytes()
        else:
            base = 0
        found = b" ".join([raw[a - base : b - base] for a, b in zip(self.start[low:high].tolist(), self.end[low:high].tolist(), strict=True)])
        return found.lower() if lower else found


def window_digests(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit cryptographic digests of the windows text[start:end], as two arrays of longs."""
    blob = b"".join([blake2b(text[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)])
    both = np.frombuffer(blob, dtype=U64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def count_words(raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Number of words of each row, without their hashes."""
    if not len(raw):
        return np.zeros(len(offsets) - 1, dtype=np.int64)
    inside = kind.take(raw)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(raw)]
    first[heads] = inside[heads]
    return np.diff(np.searchsorted(np.flatnonzero(first), offsets))


def join_grams(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a window made of two adjacent windows of equal length."""
    return mix(left * U64(0xA0761D6478BD642F) + mix(right + _STEP))


def pack64(values: np.ndarray) -> bytes:
    """64-bit values with like bytes side by side, which stream codecs then compress."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack64(blob: bytes, dtype=np.int64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, dtype=np.uint8).reshape(8, -1).T).view(dtype).ravel()


def batch_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A column of integer ids as int64 (null: 0) and a mask of the nulls."""
    null = column.is_null().to_numpy(zero_copy_only=False)
    return column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False), null


def bytes_lower(raw: bytes) -> bytes:
    """A-Z to a-z; other bytes stay."""
    return raw.lower()


def input_bytes(frame: DataFrame) -> int:
    """Bytes of the files below a frame as the optimiser sees them; never less than 1."""
    return max(1, int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().min(frame.sparkSession._jvm.scala.math.BigInt.apply(1 << 62)).longValue()))
