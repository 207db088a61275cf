"""What the linear models share: sums of vectors over all tasks, bounded samples, and the online learner."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkit as tk


#: A vector of counts is added up in so many ranges of slots, a task each.
RANGES = 32
COUNTS = "range long, slots binary, counts binary"


def counted(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of ``COUNTS`` with what isn't zero of a task's vector; none if all is."""
    at = np.flatnonzero(total)
    if not len(at):
        return
    width = -(-len(total) // RANGES)
    border = np.searchsorted(at, np.arange(RANGES + 1) * width).tolist()
    cuts = [(k, a, b) for k, (a, b) in enumerate(zip(border, border[1:], strict=False)) if b > a]
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _, _ in cuts], pa.int64()), pa.array([at[a:b].astype(np.int32).tobytes() for _, a, b in cuts], pa.binary()), pa.array([tk.pack64(total[at[a:b]]) for _, a, b in cuts], pa.binary())], names=["range", "slots", "counts"])


def summed(parts: DataFrame, size: int) -> np.ndarray:
    """Sum of the tasks' vectors (rows of ``COUNTS``), a range of slots a task: what is sent grows with the slots that
    occur, and ``size`` numbers at most come to the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for slots, counts in zip(batch.column("slots"), batch.column("counts"), strict=True):
                total[np.frombuffer(slots.as_buffer(), dtype=np.int32)] += tk.unpack64(counts.as_buffer())
        yield from counted(total)

    total = np.zeros(size, dtype=np.int64)
    for row in parts.repartition(RANGES, "range").mapInArrow(add, COUNTS).collect():
        total[np.frombuffer(bytes(row["slots"]), dtype=np.int32)] += tk.unpack64(bytes(row["counts"]))
    return total


SHARES = 1 << 30


def sample_condition(id_column: Column, group: Column, sizes: dict, quota: int, seed: int) -> Column:
    """True for about ``quota`` rows of each group, chosen by a hash of the id."""
    place = F.pmod(F.xxhash64(id_column, F.lit(seed)), F.lit(SHARES))
    chosen = F.lit(False)
    for value, n in sizes.items():
        chosen = chosen | ((group == F.lit(value)) & (place < min(SHARES, int(SHARES * quota / max(1, n)))))
    return chosen


class Ftrl:
    """Follow the regularised leader, per coordinate, with elastic-net penalties (McMahan and others, 2013).

    ``classes`` columns of weights; with one column the model is binary logistic, else softmax.
    """

    def __init__(self, slots: int, classes: int, alpha: float = 0.1, beta: float = 1.0, l1: float = 0.0, l2: float = 1.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((slots + 1, classes))
        self.n = np.zeros((slots + 1, classes))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def step(self, slots: np.ndarray, values: np.ndarray, target: np.ndarray) -> None:
        """One example; the last row of weights is the constant's. ``target`` has a probability per class."""
        at = np.append(slots, len(self.z) - 1)
        x = np.append(values, 1.0)
        w = self.weights(at)
        error = probabilities(x @ w) - target
        gradient = x[:, None] * error
        sigma = (np.sqrt(self.n[at] + gradient**2) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += gradient - sigma * w
        self.n[at] += gradient**2


def probabilities(margin: np.ndarray) -> np.ndarray:
    """Logistic of one margin, softmax of several."""
    if margin.shape[-1] == 1:
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))
    power = np.exp(margin - margin.max(axis=-1, keepdims=True))
    return power / power.sum(axis=-1, keepdims=True)
