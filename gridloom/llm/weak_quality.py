"""Quality from weak labels: heuristic labellers, their accuracies by expectation-maximisation, a linear scorer.

Each labeller votes good, bad or nothing on a text. Votes are independent given the unseen quality, so the
corpus enters the estimate only as counts of vote patterns - at most 3**5 of them however many documents -
and expectation-maximisation over these counts, on the driver, finds each labeller's vote probabilities under
either quality and the share of good texts. The posterior of a pattern is a soft label; a hashed linear model
of word and character-class n-grams is trained on the posteriors of at most ``max_train`` documents and scores
all of them, so that texts on which few labellers vote are judged by what they are made of.

Defined cases
    null or empty text: every labeller abstains but that of length, and the score is that of no features. A text of
    any length is measured whole. Null ids are scored, not sampled. Repeated rows count as often as they stand.
    Ties: a measure equal to a border votes, a mean equal to ``min_score`` is kept. An empty table gives an empty
    result; a corpus of one pattern keeps the prior. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linear
from . import textkit as tk
from .scratch import small_batches

#: A labeller's measure, the value up to which it is bad or good, and whether more is better.
LABELLERS = (
    ("words", 3.0, 50.0, True),
    ("symbol_share", 0.02, 0.004, False),
    ("letter_share", 0.70, 0.80, True),
    ("ended_line_share", 0.30, 0.80, True),
    ("repeated_share", 0.34, 0.10, False),
)
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>{}[]\\^~=_@"]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_END = np.zeros(256, dtype=bool)
_END[[ord(c) for c in ".!?\"')"]] = True
#: Classes of bytes for the shape n-grams: letters, capitals, digits, spaces and ends of lines are one each.
_SHAPE = np.arange(256, dtype=np.uint64)
_SHAPE[range(0x61, 0x7B)] = _SHAPE[range(0x80, 0x100)] = 0x61
_SHAPE[range(0x41, 0x5B)] = 0x41
_SHAPE[range(0x30, 0x3A)] = 0x30
BITS = 16


def _measures(words: tk.Words, row: int, text: bytes) -> list[float]:
    low, high = int(words.first[row]), int(words.first[row + 1])
    n, raw = high - low, np.frombuffer(text, dtype=np.uint8)
    if not n:
        return [0.0] + [float("nan")] * (len(LABELLERS) - 1)
    hashes = words.hash[low:high]
    solid = max(1, int((raw > 0x20).sum()))
    lines = [x.strip() for x in text.split(b"\n")]
    lines = [x for x in lines if x]
    ended = sum(bool(_END[x[-1]]) for x in lines) / max(1, len(lines))
    grams = hashes[:-2] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:-1] * np.uint64(0xD1342543DE82EF95) + hashes[2:] if n > 2 else hashes[:0]
    again = [1 - len(np.unique(grams)) / len(grams)] if len(grams) else []
    again += [1 - len(set(lines)) / len(lines)] if len(lines) > 1 else []
    return [
        float(n), float(_SYMBOL[raw].sum()) / solid, float(_LETTER[raw].sum()) / solid, ended,
        max(again, default=float("nan")),
    ]


def votes_of(measures: list[float]) -> list[int]:
    out = []
    for value, (_, bad, good, more) in zip(measures, LABELLERS, strict=True):
        x, a, b = (value, bad, good) if more else (-value, -bad, -good)
        out.append(0 if x != x else 1 if x >= b else -1 if x <= a else 0)
    return out


def pattern_of(votes: list[int]) -> int:
    return sum((v + 1) * 3**k for k, v in enumerate(votes))


def _features(words: tk.Words, row: int, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots and weights: words, pairs of words, and n-grams of character classes."""
    low, high = int(words.first[row]), int(words.first[row + 1])
    hashes = words.hash[low:high]
    shape = _SHAPE[np.frombuffer(text, dtype=np.uint8)]
    parts = [hashes, tk.mix(hashes[:-1] * np.uint64(3) + hashes[1:])]
    for order in (1, 2, 3):
        if len(shape) >= order:
            value = np.full(len(shape) - order + 1, order, dtype=np.uint64)
            for k in range(order):
                value = value * np.uint64(257) + shape[k : len(shape) - order + 1 + k]
            parts.append(tk.mix(value))
    slots = (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)
    counts = np.bincount(slots, minlength=1) if len(slots) else np.zeros(1, dtype=np.int64)
    at = np.flatnonzero(counts)
    value = 1 + np.log(counts[at])
    return at, value / max(1e-12, float(np.sqrt(value @ value)))


def _each(batch: pa.RecordBatch) -> Iterator[tuple[int, tk.Words, int, bytes]]:
    raw, offsets = tk.flat(batch.column("text"))
    for low, high in tk.blocks(offsets):
        part = raw[offsets[low] : offsets[high]]
        words = tk.Words(part, offsets[low : high + 1] - offsets[low], tk.SPACED, True)
        border = (offsets[low : high + 1] - offsets[low]).tolist()
        whole = part.tobytes()
        for row in range(high - low):
            yield low + row, words, row, whole[border[row] : border[row + 1]]


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [pattern_of(votes_of(_measures(words, row, text))) for _, words, row, text in _each(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int32())], names=["doc_id", "pattern"])


def estimate(patterns: dict[int, int], rounds: int = 200) -> tuple[np.ndarray, dict[int, float]]:
    """(labellers x {bad, good} x vote) probabilities and the posterior of good by pattern.

    The start fixes which of the two unseen classes is called good: any labeller finds fault with some bad
    texts and with hardly any good one. From there on every probability is estimated, one count of each vote added.
    """
    m = len(LABELLERS)
    codes = np.array(sorted(patterns), dtype=np.int64)
    n = np.array([patterns[int(c)] for c in codes], dtype=float)
    votes = (codes[:, None] // 3 ** np.arange(m)) % 3  # 0 bad, 1 nothing, 2 good
    right = np.array([[0.30, 0.20, 0.50], [0.02, 0.10, 0.88]])
    chance, good = np.repeat(right[None], m, axis=0), 0.8
    posterior = np.full(len(codes), good)
    for _ in range(rounds):
        log = np.log(chance)[np.arange(m)[None, :], :, votes].sum(axis=1) + np.log([1 - good, good])
        log -= log.max(axis=1, keepdims=True)
        posterior = np.exp(log[:, 1]) / np.exp(log).sum(axis=1)
        for y, weight in ((0, n * (1 - posterior)), (1, n * posterior)):
            for v in range(3):
                chance[:, y, v] = ((votes == v) * weight[:, None]).sum(axis=0) + 1.0
        chance /= chance.sum(axis=2, keepdims=True)
        good = float(np.clip((n @ posterior + 1) / (n.sum() + 2), 1e-3, 1 - 1e-3))
    return chance, {int(c): float(p) for c, p in zip(codes, posterior, strict=True)}


@dataclass
class Model:
    posteriors: dict[int, float]
    weights: np.ndarray

    def score(self, slots: np.ndarray, values: np.ndarray) -> float:
        return float(linear.probabilities(np.array([float(values @ self.weights[slots]) + float(self.weights[-1])]))[0])


def train(rows: DataFrame, *, max_train: int = 4000, passes: int = 4, seed: int = 31) -> Model:
    spark = rows.sparkSession
    found = rows.mapInArrow(_patterns, "doc_id long, pattern int")
    counts = {r["pattern"]: r["count"] for r in found.groupBy("pattern").count().collect()}  # at most 3**5 rows
    posteriors = spark.sparkContext.broadcast(estimate(counts)[1] if counts else {})

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"place": batch.column("place"), "target": [], "slots": [], "values": []}
            for _, words, row, text in _each(batch):
                slots, values = _features(words, row, text)
                out["target"].append(posteriors.value[pattern_of(votes_of(_measures(words, row, text)))])
                out["slots"].append(slots.astype(np.uint16).tobytes())
                out["values"].append(values.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([out["place"], pa.array(out["target"], pa.float64()), pa.array(out["slots"], pa.binary()), pa.array(out["values"], pa.binary())], names=["place", "target", "slots", "values"])

    share = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(linear.SHARES)) < min(linear.SHARES, int(linear.SHARES * max_train / max(1, sum(counts.values()))))
    chosen = rows.where(F.col("doc_id").isNotNull() & share).withColumn("place", F.xxhash64("doc_id", F.lit(seed + 1)))
    sample = chosen.select("place", "text").mapInArrow(features, "place long, target double, slots binary, values binary").toArrow().to_pylist()
    sample.sort(key=lambda r: (r["place"], r["target"]))
    learner = linear.Ftrl(1 << BITS, 1, alpha=0.5, l1=0.001, l2=0.1)
    for _ in range(passes):
        for r in sample:
            learner.step(np.frombuffer(r["slots"], dtype=np.uint16).astype(np.int64), np.frombuffer(r["values"], dtype=np.float32), np.array([r["target"]]))
    return Model(posteriors.value, learner.weights()[:, 0].astype(np.float32))


def score(documents: DataFrame, *, max_train: int = 4000, min_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_votes (labellers that vote), posterior (of good, from the votes alone), score
    (of the linear model) and kept: the mean of the two is at least ``min_score``."""
    spark = documents.sparkSession
    small_batches(spark)
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(train(rows, max_train=max_train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            number, posterior, scores = [], [], []
            for _, words, row, text in _each(batch):
                votes = votes_of(_measures(words, row, text))
                number.append(sum(v != 0 for v in votes))
                posterior.append(model.posteriors[pattern_of(votes)])
                scores.append(model.score(*_features(words, row, text)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(number, pa.int32()), pa.array(posterior, pa.float64()), pa.array(scores, pa.float64()), pa.array([(a + b) / 2 >= min_score for a, b in zip(posterior, scores, strict=True)], pa.bool_())], names=["doc_id", "n_votes", "posterior", "score", "kept"])

    return rows.mapInArrow(run, "doc_id long, n_votes int, posterior double, score double, kept boolean")
