"""Where equal hashes of different documents meet: a packed exchange by hash range.

Rows of a *state* table are blocks of documents: ``block`` (unique id), ``docs`` (int64 ids), ``owner``
(int32, document of each entry), ``hash`` (uint64 per entry) and ``guard`` (empty, or uint64 per entry: the
rest of a 128-bit digest, equal only where the hashed things are equal), all as packed bytes. A block sends
every distinct hash once, with the smallest id that has it there, so a hash that a third of the corpus holds
costs one entry a block and no task gathers its documents. Back comes one byte per entry.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textkit as tk

#: Entries that a task of the exchange holds, about.
ENTRIES_A_TASK = 250_000
REPEATED, FIRST_HERE = 1, 2

_SENT = "bucket long, block long, hash binary, guard binary, least binary, many binary"
_BACK = "block long, bucket long, flags binary"


def _ordered(hashes: np.ndarray, guards: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal entries together, and in it the places where a new value begins."""
    order = np.argsort(hashes, kind="stable")
    values = hashes[order]
    fresh = values[1:] != values[:-1]
    if guards is not None:
        apart = guards[order][1:] != guards[order][:-1]
        if (apart & ~fresh).any():
            order = np.lexsort((guards, hashes))
            values = hashes[order]
            apart = (values[1:] != values[:-1]) | (guards[order][1:] != guards[order][:-1])
        fresh = fresh | apart
    return order, np.flatnonzero(np.concatenate([[True], fresh]))


def _guards(row: dict) -> np.ndarray | None:
    return np.frombuffer(row["guard"], dtype=np.uint64) if row["guard"] else None


def distinct(docs: np.ndarray, owner: np.ndarray, hashes: np.ndarray, guards: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of a block in order, their guards, the least id of each, whether several ids have it, and
    the place of each entry among them."""
    if not len(hashes):
        return hashes, hashes, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.int64)
    order, head = _ordered(hashes, guards)
    who = docs[owner[order]]
    least = np.minimum.reduceat(who, head)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(order))))
    kept = hashes[:0] if guards is None else guards[order[head]]
    return hashes[order[head]], kept, least, (np.maximum.reduceat(who, head) > least).astype(np.uint8), place


def buckets_of(hashes: np.ndarray, bits: int) -> tuple[list[int], np.ndarray]:
    """Buckets of hashes in order, and the borders of their runs."""
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    border = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, dtype=np.int64)
    return bucket[border].tolist(), np.append(border, len(bucket))


def tasks_for(entries: int) -> int:
    return max(8, math.ceil(entries / ENTRIES_A_TASK))


def bits_for(tasks: int) -> int:
    return max(1, math.ceil(math.log2(2 * tasks)))


def repeated(state: DataFrame, tasks: int) -> DataFrame:
    """For each block and bucket, a byte per distinct hash: REPEATED if documents of other ids have it too
    (here or elsewhere), FIRST_HERE if the least id of all is the block's own least."""
    bits = bits_for(tasks)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, guards, least, many, _ = distinct(tk.unpack64(row["docs"]), np.frombuffer(row["owner"], dtype=np.int32), np.frombuffer(row["hash"], dtype=np.uint64), _guards(row))
                bucket, border = buckets_of(values, bits)
                cuts = list(zip(border[:-1].tolist(), border[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(bucket, pa.int64()), "block": pa.array([row["block"]] * len(cuts), pa.int64()),
                    "hash": pa.array([values[a:b].tobytes() for a, b in cuts], pa.binary()), "guard": pa.array([guards[a:b].tobytes() for a, b in cuts], pa.binary()),
                    "least": pa.array([tk.pack64(least[a:b]) for a, b in cuts], pa.binary()),
                    "many": pa.array([many[a:b].tobytes() for a, b in cuts], pa.binary()),
                })

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, block, hashes, guards, least, many = [], [], [], [], [], []
        for batch in batches:
            bucket += batch.column("bucket").to_pylist()
            block += batch.column("block").to_pylist()
            hashes += [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in batch.column("hash")]
            guards += [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in batch.column("guard")]
            least += [tk.unpack64(x.as_buffer()) for x in batch.column("least")]
            many += [np.frombuffer(x.as_buffer(), dtype=np.uint8) for x in batch.column("many")]
        if not hashes:
            return
        border = np.concatenate([[0], np.cumsum([len(x) for x in hashes])]).tolist()
        values, strict, who, several = np.concatenate(hashes), np.concatenate(guards), np.concatenate(least), np.concatenate(many)
        del hashes, guards, least, many
        order, head = _ordered(values, strict if len(strict) else None)
        size = np.diff(np.append(head, len(order)))
        low = np.minimum.reduceat(who[order], head)
        met = (np.maximum.reduceat(who[order], head) > low) | (np.maximum.reduceat(several[order], head) > 0)
        flags = np.zeros(len(order), dtype=np.uint8)
        flags[order] = np.repeat(met, size) * REPEATED + (np.repeat(low, size) == who[order]) * FIRST_HERE
        flags[(flags & REPEATED) == 0] = 0
        keep = [k for k in range(len(block)) if flags[border[k] : border[k + 1]].any()]
        for at in range(0, len(keep), 4096):
            part = keep[at : at + 4096]
            yield pa.RecordBatch.from_pydict({"block": pa.array([block[k] for k in part], pa.int64()), "bucket": pa.array([bucket[k] for k in part], pa.int64()), "flags": pa.array([flags[border[k] : border[k + 1]].tobytes() for k in part], pa.binary())})

    return state.select("block", "docs", "owner", "hash", "guard").mapInArrow(send, _SENT).repartition(tasks, "bucket").mapInArrow(meet, _BACK)


def flags_of(row: dict, back: list[dict], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of a block's row: is its hash repeated, and has a document of a smaller id it?"""
    docs, owner, hashes = tk.unpack64(row["docs"]), np.frombuffer(row["owner"], dtype=np.int32), np.frombuffer(row["hash"], dtype=np.uint64)
    values, _, least, _, place = distinct(docs, owner, hashes, _guards(row))
    bucket, border = buckets_of(values, bits)
    cut = dict(zip(bucket, zip(border[:-1].tolist(), border[1:].tolist(), strict=True), strict=True))
    flags = np.zeros(len(values), dtype=np.uint8)
    for x in back:
        low, high = cut[x["bucket"]]
        flags[low:high] = np.frombuffer(x["flags"], dtype=np.uint8)
    mine = flags[place]
    again = (mine & REPEATED) > 0
    return again, again & (((mine & FIRST_HERE) == 0) | (docs[owner] > least[place]))
