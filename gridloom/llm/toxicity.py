"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

The ratios come from the presence counts of every n-gram slot in all labelled rows that may be learnt from
(after Wang and Manning, 2012), drawn towards zero by ``doubt`` standard errors, so that n-grams seen a few
times say little; the classifier on top is trained on at most ``max_train`` of these rows, half
of either class where there are enough, and its constant is set back to the classes' true shares. A training row
takes 64 KB on the driver at most.

Labels meet the documents by id: broadcast while they are no more than ``BROADCAST_LABELS`` rows, else by a
shuffled join of the labelled documents. Scoring is one pass without a shuffle.

Defined cases
    null or empty text: no n-grams, the constant's score. A text of any length is read whole. Ties: a score of 0.5 is
    predicted toxic. An empty table gives an empty result. Labels that are null or for unknown ids teach
    nothing; an id with several labels is toxic if one says so; rows that repeat an id are examples each.
    Without labels of both classes every score is 0. Null ids are scored and never learnt from. Other columns
    are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import linear
from .charfeatures import Counter, letters
from .scratch import small_batches

ORDERS, BITS = (4, 5, 6), 19
SLOTS = 1 << BITS
BROADCAST_LABELS = 2_000_000


@dataclass
class Model:
    weights: np.ndarray  # of a slot's presence: ratio times learnt weight
    constant: float

    def score(self, slots: np.ndarray) -> float:
        return float(linear.probabilities(np.array([self.weights[slots].sum(dtype=np.float64) + self.constant]))[0])


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter, total = Counter(ORDERS, BITS), np.zeros(2 * (SLOTS + 1), dtype=np.int64)
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            part = total[toxic * (SLOTS + 1) : (toxic + 1) * (SLOTS + 1)]
            part[counter.of(letters(text or ""))[0]] += 1
            part[-1] += 1
    yield from linear.counted(total)


def _packed(slots: np.ndarray) -> bytes:
    """Slots as a first byte and numbers, or as a bitmap if that is less: 64 KB at most, however long the text."""
    if 4 * len(slots) < SLOTS // 8:
        return b"n" + slots.astype(np.int32).tobytes()
    held = np.zeros(SLOTS, dtype=bool)
    held[slots] = True
    return b"b" + np.packbits(held).tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    if blob[:1] == b"n":
        return np.frombuffer(blob, dtype=np.int32, offset=1)
    return np.flatnonzero(np.unpackbits(np.frombuffer(blob, dtype=np.uint8, offset=1)))


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = Counter(ORDERS, BITS)
    for batch in batches:
        found = [_packed(counter.of(letters(text or ""))[0]) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("place"), pa.array(found, pa.binary())], names=["label", "place", "slots"])


def train(rows: DataFrame, *, max_train: int = 4000, rounds: int = 4, alpha: float = 0.1, l2: float = 1.0, doubt: float = 1.5, seed: int = 23) -> Model | None:
    """A model from rows of (doc_id, text, label 0 or 1); None unless both labels occur."""
    counts = linear.summed(rows.select("text", "label").mapInArrow(_presence, linear.COUNTS), 2 * (SLOTS + 1))
    clean, toxic = counts[: SLOTS + 1], counts[SLOTS + 1 :]
    sizes = {0: int(clean[-1]), 1: int(toxic[-1])}
    if not all(sizes.values()):
        return None
    ratio = np.log((1 + toxic[:-1]) / (2 + toxic[-1])) - np.log((1 + clean[:-1]) / (2 + clean[-1]))
    error = np.sqrt(1 / (1 + toxic[:-1]) + 1 / (1 + clean[:-1]))  # standard error of the log ratio
    ratio = np.sign(ratio) * np.maximum(0.0, np.abs(ratio) - doubt * error)
    chosen = rows.where(linear.sample_condition(F.col("doc_id"), F.col("label"), sizes, max_train // 2, seed))
    sample = chosen.select("text", "label", F.xxhash64("doc_id", F.lit(seed + 1)).alias("place")).mapInArrow(_slots, "label int, place long, slots binary").toArrow().to_pylist()
    sample.sort(key=lambda r: (r["place"], r["label"]))
    learner = linear.Ftrl(SLOTS, 1, alpha=alpha, l2=l2)
    for _ in range(rounds):
        for r in sample:
            slots = _unpacked(r["slots"])
            learner.step(slots, ratio[slots], np.array([float(r["label"])]))
    weights = learner.weights()[:, 0]
    held = [sum(r["label"] == k for r in sample) for k in (0, 1)]
    shift = np.log(sizes[1] / sizes[0]) - np.log(max(1, held[1]) / max(1, held[0]))
    return Model((weights[:-1] * ratio).astype(np.float32), float(weights[-1] + shift))


def score(documents: DataFrame, labels: DataFrame, *, max_train: int = 4000, folds: int = 5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per document: doc_id, held_out (its fold is not learnt from), score from 0 to 1 and predicted."""
    spark = documents.sparkSession
    small_batches(spark)
    held = F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string")) % folds == 0, F.lit(False))
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held.alias("held_out"))
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    few = known.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    learnt = rows.where("not held_out").join(F.broadcast(known) if few else known, "doc_id").select("doc_id", "text", "label")
    shared = spark.sparkContext.broadcast(train(learnt, max_train=max_train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, model = Counter(ORDERS, BITS), shared.value
        for batch in batches:
            scores = [model.score(counter.of(letters(text or ""))[0]) if model else 0.0 for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array([int(x >= 0.5) for x in scores], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    return rows.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
