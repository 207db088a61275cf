"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over every row that may be learnt from; the classifier is trained on a
sample of at most ``max_train`` of these rows (shared evenly by the languages), by follow-the-regularised-
leader with elastic-net penalties, and a temperature fitted on a fifth of the sample that training doesn't
see calibrates the probabilities. Scoring is one pass without a shuffle.

Defined cases
    A null text, or one without a letter: ``und`` with score 0. A text of any length is read whole. No row to learn
    from, or an empty table: ``und`` for all. Null ids are scored but never learnt from. Repeated rows count as often as they stand. Equal probabilities:
    the first language in string order. Other columns, also ones named like results, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linear
from .charfeatures import SPACE, Counter, letters
from .scratch import small_batches

ORDERS, BITS = (1, 2, 3), 15
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def probabilities(self, slots: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = tfidf(slots, counts, self.idf)
        margin = x @ self.weights[slots] + self.weights[-1]
        return linear.probabilities(margin / self.temperature) if len(self.languages) > 1 else np.ones(1)


def tfidf(slots: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    value = (1.0 + np.log(counts)) * idf[slots]
    return value / max(1e-12, float(np.sqrt(value @ value)))


def learnable(id_column: Column, folds: int = 4, held: int = 2) -> Column:
    """Not in the held-out fold."""
    return F.crc32(id_column.cast("string")) % folds != held


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter, total = Counter(ORDERS, BITS), np.zeros((1 << BITS) + 1, dtype=np.int64)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            total[counter.of(letters(text))[0]] += 1
            total[-1] += 1
    yield from linear.counted(total)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = Counter(ORDERS, BITS)
    for batch in batches:
        found = [counter.of(letters(text)) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("place"), pa.array([a.astype(np.uint16).tobytes() for a, _ in found], pa.binary()), pa.array([b.astype(np.float32).tobytes() for _, b in found], pa.binary())], names=["lang", "place", "slots", "counts"])


def train(rows: DataFrame, *, max_train: int = 3000, rounds: int = 3, l1: float = 0.02, l2: float = 0.5, alpha: float = 0.3, seed: int = 11) -> Model | None:
    """A model from rows of (doc_id, text, lang); None if there are none."""
    rows = rows.where("text is not null and lang is not null and doc_id is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # as many rows as languages
    if not sizes:
        return None
    frequency = linear.summed(rows.select("text").mapInArrow(_frequencies, linear.COUNTS), (1 << BITS) + 1)
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1
    chosen = rows.where(linear.sample_condition(F.col("doc_id"), F.col("lang"), sizes, max(1, max_train // len(sizes)), seed))
    sample = chosen.select("text", "lang", F.xxhash64("doc_id", F.lit(seed + 1)).alias("place")).mapInArrow(_features, "lang string, place long, slots binary, counts binary").toArrow().to_pylist()
    sample.sort(key=lambda r: (r["place"], r["lang"]))
    languages = sorted(sizes)
    examples = []
    for r in sample:
        slots = np.frombuffer(r["slots"], dtype=np.uint16).astype(np.int64)
        if len(slots):
            examples.append((slots, tfidf(slots, np.frombuffer(r["counts"], dtype=np.float32), idf), languages.index(r["lang"])))
    held, learnt = examples[::5], [x for k, x in enumerate(examples) if k % 5]
    learner = linear.Ftrl(1 << BITS, len(languages), alpha=alpha, l1=l1, l2=l2)
    targets = np.eye(len(languages))
    for _ in range(rounds if len(languages) > 1 else 0):
        for slots, values, language in learnt:
            learner.step(slots, values, targets[language])
    weights = learner.weights().astype(np.float32)
    margins = np.array([values @ weights[slots] + weights[-1] for slots, values, _ in held])
    return Model(languages, idf, weights, _temperature(margins, np.array([x[2] for x in held], dtype=int)))


def _temperature(margins: np.ndarray, truth: np.ndarray) -> float:
    """The divisor of the margins with the least log loss, by golden section over its logarithm."""
    if not len(truth) or margins.shape[1] < 2:
        return 1.0

    def loss(log_t: float) -> float:
        p = linear.probabilities(margins / np.exp(log_t))
        return -float(np.mean(np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12))))

    low, high, part = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _score(batch_texts: list[str | None], counter: Counter, model: Model | None) -> tuple[list[str], list[float]]:
    names, scores = [], []
    for text in batch_texts:
        codes = letters(text or "")
        if model is None or not (codes != SPACE).any():
            names.append(UNKNOWN)
            scores.append(0.0)
            continue
        p = model.probabilities(*counter.of(codes))
        best = int(np.argmax(p))
        names.append(model.languages[best])
        scores.append(float(p[best]))
    return names, scores


def identify(documents: DataFrame, *, max_train: int = 3000, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: doc_id, held_out (not learnt from), lang_pred and score, its calibrated probability.
    ``learn`` says of which rows text and language may be learnt; by default of three folds in four."""
    spark = documents.sparkSession
    small_batches(spark)
    learn = learnable(F.col(id_col)) if learn is None else learn
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.coalesce(learn, F.lit(True)).alias("learn"))
    shared = spark.sparkContext.broadcast(train(rows.where("learn"), max_train=max_train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, model = Counter(ORDERS, BITS), shared.value
        for batch in batches:
            names, scores = _score(batch.column("text").to_pylist(), counter, model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.select("doc_id", (~F.col("learn")).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(documents: DataFrame, *, languages: list[str] | None = None, min_score: float = 0.5, max_train: int = 3000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Documents with all their columns whose language is known with ``min_score`` (and among ``languages``)."""
    spark = documents.sparkSession
    small_batches(spark)
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    shared = spark.sparkContext.broadcast(train(rows.where(learnable(F.col("doc_id"))), max_train=max_train))
    place, wanted = documents.columns.index(text_col), languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, model = Counter(ORDERS, BITS), shared.value
        for batch in batches:
            names, scores = _score(batch.column(place).cast(pa.string()).to_pylist(), counter, model)
            good = [n != UNKNOWN and s >= min_score and (wanted is None or n in wanted) for n, s in zip(names, scores, strict=True)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
