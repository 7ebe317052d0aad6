"""Many units under many weight vectors, as matrices of whole numbers.

What SQL says of a unit and a vector row by row (``index.need_terms``, a gain, a place) is said here of blocks of both, so that
units x draws need not be rows. A missing need or gain is ``NONE``, which lies below every number.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy

import numpy as np

NONE = -(1 << 40)
LIMIT = 1 << 40
"""Needs and gains stay below this, which leaves 22 bits of a sort key for a unit's place."""

EXACT = 1 << 53
"""Below this doubles hold whole numbers, and a truncated quotient of two of them is exact."""

BLOCK = 1 << 20
"""Needs that are held at once, roughly."""


def quotient(num: np.ndarray, den: np.ndarray) -> np.ndarray:
    """SQL's ``div``, which truncates; NONE where the divisor is 0."""
    known = den != 0
    den = den if known.all() else np.where(known, den, 1)
    if num.dtype == np.float64:
        out = (num / den).astype(np.int64)
    else:
        out = np.abs(num) // np.abs(den) * (np.sign(num) * np.sign(den))
    if (np.abs(out) >= LIMIT).any():
        raise OverflowError("a need or gain is too large")
    return out if known.all() else np.where(known, out, NONE)


class Units:
    """Units by their percentiles; ``has`` tells which a unit has."""

    def __init__(self, p: np.ndarray, has: np.ndarray):
        self.n, self.most, self.all_there = len(p), int(np.abs(p).max(initial=0)), bool(has.all())
        self.p, self.has = np.ascontiguousarray(p.T), np.ascontiguousarray(has.T)
        self._doubles = self.most < EXACT
        if self._doubles:
            self.p, self.has = self.p.astype(np.float64), None if self.all_there else self.has.astype(np.float64)

    @classmethod
    def of_rows(cls, p: np.ndarray, has: np.ndarray | None) -> Units:
        """The same from one row per percentile, which is kept as it is; ``has`` is None if no unit lacks one."""
        out = object.__new__(cls)
        out.n, out.most, out.all_there = p.shape[1], max(int(p.max(initial=0)), -int(p.min(initial=0))), has is None
        out.p, out.has, out._doubles = p, has, out.most < EXACT
        return out

    def part(self, low: int, high: int) -> Units:
        out = copy(self)
        out.n, out.p, out.has = high - low, self.p[:, low:high], None if self.has is None else self.has[:, low:high]
        return out

    def needs(self, w: np.ndarray) -> np.ndarray:
        """Need by vector (rows) and unit (columns): weights are renormalised over the percentiles that a unit has."""
        bound = int(np.abs(w).sum(1).max(initial=0)) * self.most
        if bound >= 1 << 63:
            raise OverflowError("weighted percentiles are too large")
        kind = np.float64 if self._doubles and bound < EXACT else np.int64
        v = w.astype(kind)
        p = self.p if self.p.dtype == kind else self.p.astype(kind)
        covered = v.sum(1, keepdims=True) if self.all_there else v @ self.has.astype(kind)
        return quotient(v @ p, covered)


def vector_blocks(w: np.ndarray, n: int) -> Iterator[slice]:
    """Slices of the vectors under which ``n`` units make about a block of needs."""
    step = max(1, BLOCK // max(n, 1))
    return (slice(i, min(i + step, len(w))) for i in range(0, len(w), step))


def gains(need: np.ndarray, served: np.ndarray, by: np.ndarray, known: np.ndarray) -> np.ndarray:
    """need x served div by; NONE where one is missing."""
    if known.any() and (by[known] == 0).any():
        raise ZeroDivisionError("a gain is divided by 0")
    there = (need != NONE) & known
    need = need if there.all() else np.where(there, need, 0)
    bound = int(np.abs(need).max(initial=0)) * int(np.abs(served).max(initial=0))
    if bound >= 1 << 63:
        raise OverflowError("a gain is too large")
    kind = np.float64 if bound < EXACT else np.int64
    out = quotient(need.astype(kind) * served.astype(kind), np.where(known, by, 1).astype(kind)[None, :])
    return np.where(there, out, NONE)


def _bits(n: int, most: int = 22) -> int:
    bits = max(1, (n - 1).bit_length())
    if bits > most:
        raise OverflowError("too many units for one block")
    return bits


def best_of_groups(value: np.ndarray, starts: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """(vector, place) of the ``cap`` units with the highest value of every group, ties by the smaller place.

    Units are sorted by group; ``starts`` are the first places of the groups.
    """
    bits, rows, places = _bits(value.shape[1]), [], []
    mask = (1 << bits) - 1
    key = (value << bits) | (mask - np.arange(value.shape[1]))
    gone = np.iinfo(np.int64).min
    for _ in range(cap):
        best = np.maximum.reduceat(key, starts, axis=1)
        row, _group = np.nonzero(best != gone)
        if not len(row):
            break
        place = mask - (best[best != gone] & mask)
        key[row, place] = gone
        rows.append(row)
        places.append(place)
    return (np.concatenate(rows), np.concatenate(places)) if rows else (np.zeros(0, int), np.zeros(0, int))


def _keys(need: np.ndarray, bits: int, first: int = 0) -> np.ndarray:
    """Sort keys, highest need first and ties by place, of units from place ``first``; a missing need comes last."""
    limit = 1 << (62 - bits)
    if limit < LIMIT:
        there = need != NONE
        if (np.abs(need, where=there, out=np.zeros_like(need)) >= limit).any():
            raise OverflowError("a need is too large for so many units")
        need = np.where(there, need, -limit)
    return (-need << bits) | np.arange(first, first + need.shape[1])


def order_keys(need: np.ndarray) -> tuple[np.ndarray, int]:
    """Sort keys, highest need first and ties by place, and the mask of a key's place."""
    bits = _bits(need.shape[1])
    return _keys(need, bits), (1 << bits) - 1


STRIP = 1 << 14
"""Units whose keys are made at once: what they take stays near the processor."""


def rank_sums(units: Units, w: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per unit over all vectors: how often its rank is at most ``top``, and the sum, least and greatest of its ranks."""
    n = units.n
    bits = _bits(n, 30)
    in_top, total = np.zeros(n, np.int32), np.zeros(n, np.int64)
    least, greatest = np.full(n, n + 1, np.int32), np.zeros(n, np.int32)
    places, rank = np.arange(1, n + 1, dtype=np.int32), np.empty(n, np.int32)
    for part in vector_blocks(w, n):
        keys = np.empty((len(w[part]), n), np.int64)
        for low in range(0, n, STRIP):
            high = min(n, low + STRIP)
            keys[:, low:high] = _keys(units.part(low, high).needs(w[part]), bits, low)
        for at in keys:
            at.sort()
            at &= (1 << bits) - 1
            rank[at] = places
            in_top[at[:top]] += 1
            total += rank
            np.minimum(least, rank, out=least)
            np.maximum(greatest, rank, out=greatest)
    return in_top, total, least, greatest


def quantile_at(values: np.ndarray, upto: np.ndarray, q: float) -> float:
    """``percentile`` of sorted values; ``upto`` counts the rows up to and with each."""
    position = float(upto[-1] - 1) * q
    low, high = np.floor(position), np.ceil(position)
    a, b = (float(values[np.searchsorted(upto, p, side="right")]) for p in (low, high))
    return a if low == high or a == b else (high - position) * a + (position - low) * b


def quantiles(rows: np.ndarray, copies: np.ndarray, q: float) -> np.ndarray:
    """``percentile`` of each row of sorted values, every one of them ``copies`` times; NONE, which comes first, is left out."""
    width = rows.shape[1]
    missing = (rows == NONE).sum(1)
    many = (width - missing) * copies
    position = (many - 1).astype(np.float64) * q
    low, high = np.floor(position), np.ceil(position)
    line = np.arange(len(rows))

    def at(place: np.ndarray) -> np.ndarray:
        return rows[line, np.clip(missing + place.astype(np.int64) // copies, 0, width - 1)].astype(np.float64)
    a, b = at(low), at(high)
    out = np.where((low == high) | (a == b), a, (high - position) * a + (position - low) * b)
    return np.where(many > 0, out, np.nan)
