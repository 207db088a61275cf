"""Hashed character n-grams of texts, as sparse counts, for the linear models."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SPACE = 0x20
_BASIC = 0x3000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of each code point below 0x3000, a space for whatever is no letter."""
    table = np.full(_BASIC, SPACE, dtype=np.uint32)
    for c in range(_BASIC):
        low = chr(c).lower()
        if chr(c).isalpha():
            table[c] = ord(low[0])
    return table


def letters(text: str) -> np.ndarray:
    """Code points of a text, in lower case, everything but letters (and whatever lies beyond) as one space."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = codes < _BASIC
    value = _letters().take(np.where(low, codes, 0))
    if not low.all():
        rest = np.flatnonzero(~low)
        value[rest] = [c if chr(c).isalpha() else SPACE for c in codes[rest].tolist()]
    value = np.concatenate([[SPACE], value, [SPACE]]).astype(np.uint32)
    gap = value == SPACE
    keep = np.ones(len(value), dtype=bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    return value[keep]


def grams(codes: np.ndarray, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """Slots, in 2**bits, of all n-grams of the orders given. A gram of spaces alone doesn't come up."""
    out = []
    base = codes.astype(np.uint64)
    for order in orders:
        if len(base) < order:
            continue
        value = np.full(len(base) - order + 1, order, dtype=np.uint64)
        for k in range(order):
            value = (value ^ base[k : len(base) - order + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        if order == 1:
            value = value[base != SPACE]
        out.append((value * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


class Counter:
    """Counts of slots of one text, with a buffer that is reused."""

    def __init__(self, orders: tuple[int, ...], bits: int):
        self.orders, self.bits = orders, bits

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ordered slots, their counts) of what ``letters`` made of a text."""
        found = grams(codes, self.orders, self.bits)
        if len(found) > 1 << (self.bits - 4):
            counts = np.bincount(found, minlength=1 << self.bits)
            slots = np.flatnonzero(counts)
            return slots, counts[slots]
        found.sort()
        head = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else found
        return found[head], np.diff(np.append(head, len(found)))
