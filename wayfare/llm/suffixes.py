"""Suffix array of whole numbers, a wavelet matrix over it, and questions to both for many places at once."""

from __future__ import annotations

import numpy as np


class Suffixes:
    """Suffix array by doubling, with the class of every stretch of 2**k symbols kept for each k.

    ``ranks[k][i]`` is the first place in the suffix array of all suffixes that
    begin with the 2**k symbols at ``i``, so equal numbers mean equal stretches
    and a number opens an interval of the suffix array. Only suffixes that are
    not yet alone in their class are sorted again; ``active[k]`` and ``sizes[k]`` are
    these and the sizes of their classes. Symbols past the end differ from all
    others.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        counts = np.bincount(symbols) if n else np.zeros(0, np.int64)
        starts = np.cumsum(counts) - counts
        rank = starts[symbols].astype(np.int32)
        sizes = counts[symbols]
        active = np.flatnonzero(sizes > 1)
        self.n, self.ranks, self.active, self.sizes = n, [rank], [active], [sizes[active]]
        while len(active):
            step = 1 << (len(self.ranks) - 1)
            rank = rank.copy()
            self.ranks.append(rank)
            active, sizes = self._refine(rank, active, step)
            self.active.append(active)
            self.sizes.append(sizes)

    def _refine(self, rank: np.ndarray, active: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Part the classes of ``active`` by the class ``step`` further on; returns those still not alone, and their class sizes."""
        first = rank[active].astype(np.int64)
        after = active + step
        second = np.zeros(len(active), np.int64)
        inside = after < self.n
        second[inside] = rank[after[inside]] + 1
        keys = first * (self.n + 1) + second
        order = np.argsort(keys)
        keys, first, active = keys[order], first[order], active[order]
        at = np.arange(len(keys))
        opens = np.empty(len(keys), bool)
        opens[0] = True
        np.not_equal(keys[1:], keys[:-1], out=opens[1:])
        group = np.maximum.accumulate(np.where(opens, at, 0))
        opens_class = np.empty(len(keys), bool)
        opens_class[0] = True
        np.not_equal(first[1:], first[:-1], out=opens_class[1:])
        whole = np.maximum.accumulate(np.where(opens_class, at, 0))
        rank[active] = first + group - whole
        heads = np.flatnonzero(opens)
        sizes = np.repeat(np.diff(np.append(heads, len(keys))), np.diff(np.append(heads, len(keys))))
        left = sizes > 1
        return active[left], sizes[left]

    def array(self) -> np.ndarray:
        """The suffix array: places in the order of their suffixes."""
        out = np.empty(self.n, np.int32)
        out[self.ranks[-1]] = np.arange(self.n, dtype=np.int32)
        return out

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that agree from each ``a`` and ``b`` (a <> b) onwards."""
        return self._agree(a, b, 1)

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that agree before each ``a`` and ``b`` (a <> b)."""
        return self._agree(a, b, -1)

    def _agree(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        a, b = a.astype(np.int64), b.astype(np.int64)
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            size, rank = 1 << k, self.ranks[k]
            x, y = (a + total, b + total) if way > 0 else (a - total - size, b - total - size)
            fits = np.flatnonzero((np.minimum(x, y) >= 0) & (np.maximum(x, y) < self.n))
            # A stretch over the end is equal to no other, so equal classes are equal stretches of full length.
            same = fits[rank[x[fits]] == rank[y[fits]]]
            total[same] += size
        return total


class Wavelet:
    """Wavelet matrix: values by their bits, highest first; counts and order statistics of any interval in one step a bit."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self._ones, self._zeros = bits, [], []
        values = values.astype(np.int64)
        for bit in range(bits - 1, -1, -1):
            high = (values >> bit) & 1 == 1
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(high, out=ones[1:])
            self._ones.append(ones)
            self._zeros.append(len(values) - int(ones[-1]))
            values = np.concatenate([values[~high], values[high]])

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values of each interval [low, high) are smaller than ``value``."""
        low, high = low.astype(np.int64), high.astype(np.int64)
        every, out = high - low, np.zeros(len(low), np.int64)
        for ones, zeros, bit in zip(self._ones, self._zeros, range(self.bits - 1, -1, -1)):
            one_low, one_high = ones[low], ones[high]
            up = (value >> bit) & 1 == 1
            out += np.where(up, (high - one_high) - (low - one_low), 0)
            low, high = np.where(up, zeros + one_low, low - one_low), np.where(up, zeros + one_high, high - one_high)
        return np.where(value >> self.bits > 0, every, out)

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) of each interval [low, high)."""
        low, high, k = low.astype(np.int64), high.astype(np.int64), k.astype(np.int64)
        out = np.zeros(len(low), np.int64)
        for ones, zeros, bit in zip(self._ones, self._zeros, range(self.bits - 1, -1, -1)):
            one_low, one_high = ones[low], ones[high]
            fewer = (high - one_high) - (low - one_low)
            up = k >= fewer
            out += up.astype(np.int64) << bit
            k = np.where(up, k - fewer, k)
            low, high = np.where(up, zeros + one_low, low - one_low), np.where(up, zeros + one_high, high - one_high)
        return out
