"""Best or near rows among all pairs of two blocks: tiles are scored in single precision, what can count is settled in double.

A tile of the product of two sets of vectors is compared with what a row has to
reach, less the rounding of single precision; only the few pairs that pass are
scored again in double precision, and they alone are ranked or counted. Where
very many pass (equal vectors), the whole tile is scored in double precision.
The results are those of scoring every pair in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Rows and columns of a tile; counting adds up bytes, so a tile has fewer than 8 * 256 columns.
ROWS, COLS = 256, 2040
#: Where a tile has more candidates than this share of it, it is scored in double precision.
DENSE = 1 / 16
#: Share of the lists from which on rows meet all of them.
MOSTLY = 0.5
#: Pairs scored in double precision at a time.
SETTLED = 1 << 15
NONE = np.iinfo(np.int64).max


def rounding(x: np.ndarray, y: np.ndarray) -> float:
    """What a product of rows of both can be off in single precision."""
    longest = (np.sqrt((m * m).sum(1).max(initial=0.0)) for m in (x, y))
    return (x.shape[1] + 8) * 2.0 ** -23 * np.prod([*longest])


def products(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """The product of each pair of rows, in double precision."""
    parts = [np.einsum("ij,ij->i", a[rows[i:i + SETTLED]], b[cols[i:i + SETTLED]]) for i in range(0, len(rows), SETTLED)]
    return np.concatenate(parts) if parts else np.zeros(0)


_buffers: dict[str, np.ndarray] = {}


def _buffer(name: str, kind: type, *shape: int) -> np.ndarray:
    """A part of an array that every tile uses again."""
    n = int(np.prod(shape))
    if name not in _buffers or _buffers[name].size < n:
        _buffers[name] = np.empty(max(n, ROWS * 8 * 256), kind)
    return _buffers[name][:n].reshape(shape)


def product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``x @ y.T`` of a tile; it holds until the next one."""
    return np.matmul(x, y.T, out=_buffer("rough", np.float32, len(x), len(y)))


def reaching(rough: np.ndarray, bar: np.ndarray) -> np.ndarray:
    """Which values of each row are not below its bar; columns are filled up to eights, so that eight are looked at in one. Holds until the next one."""
    n, width = rough.shape
    full = _buffer("passed", np.bool_, n, -(-width // 8) * 8)
    full[:, width:] = False
    np.greater_equal(rough, bar[:, None].astype(np.float32), out=full[:, :width])
    return full


def places(full: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of what is true."""
    words = full.reshape(-1).view(np.uint64)
    some = np.flatnonzero(words)
    word, byte = np.nonzero(words[some].view(np.uint8).reshape(-1, 8))
    return np.divmod(some[word] * 8 + byte, full.shape[1])


class Segments:
    """The tiles of two blocks: all pairs, or those of rows that visit lists with the rows of these lists.

    Rows that visit most lists meet all, in large tiles; ``holds`` tells which pairs were asked for.
    """

    def __init__(self, n: int, m: int, met: np.ndarray | None = None, ends: np.ndarray | None = None):
        """``met``: which lists each row visits (rows x lists); columns lie in the order of lists that end at ``ends``."""
        self.n, self.m, self.met, self.ends = n, m, met, ends
        #: So many rows at a time that about ``ROWS`` of them visit a list.
        self.step = ROWS if met is None else int(min(max(n, 1), ROWS / max(met.mean() if met.size else 1.0, 1e-9)))

    def holds(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """Whether the pairs are of a row and a list that it visits."""
        return np.ones(len(rows), bool) if self.met is None else self.met[rows, np.searchsorted(self.ends, cols, side="right")]

    def shut(self, rows: np.ndarray, cols: slice) -> np.ndarray:
        """Of a tile, the pairs that were not asked for (rows x columns)."""
        return ~self.met[rows[:, None], np.searchsorted(self.ends, np.arange(cols.start, cols.stop), side="right")]

    def __iter__(self) -> Iterator[tuple[int, int, Iterator]]:
        for i in range(0, self.n, self.step):
            upto = min(i + self.step, self.n)
            yield i, upto, self._tiles(i, upto)

    def _tiles(self, i: int, upto: int) -> Iterator[tuple[np.ndarray | slice, slice]]:
        for rows, start, end in self._runs(i, upto):
            whole = isinstance(rows, slice)
            for a in range(0, upto - i if whole else len(rows), ROWS):
                some = slice(i + a, min(i + a + ROWS, upto)) if whole else rows[a:a + ROWS]
                for j in range(start, end, COLS):
                    yield some, slice(j, min(j + COLS, end))

    def _runs(self, i: int, upto: int) -> Iterator[tuple[np.ndarray | slice, int, int]]:
        if self.met is None:
            yield slice(i, upto), 0, self.m
            return
        met = self.met[i:upto]
        if met.mean() >= MOSTLY:
            yield slice(i, upto), 0, self.m
            return
        visitors = met.sum(axis=0)
        start, begun = 0, None  # where columns of lists begin that lie next to each other and that all rows visit
        for k, end in enumerate(self.ends):
            if visitors[k] == len(met):
                begun = start if begun is None else begun
            else:
                if begun is not None:
                    yield slice(i, upto), begun, start
                    begun = None
                if visitors[k]:
                    yield i + np.flatnonzero(met[:, k]), start, end
            start = end
        if begun is not None:
            yield slice(i, upto), begun, start


class Cosines:
    """Cosines of unit rows, rounded to so many digits; higher is better."""

    def __init__(self, a: np.ndarray, b: np.ndarray, digits: int):
        self.a, self.b, self.digits = a, b, digits
        self.x, self.y = a.astype(np.float32), b.astype(np.float32)
        self.slack = rounding(a, b) + 0.51 * 10.0 ** -digits

    def rough(self, rows, cols):
        return product(self.x[rows], self.y[cols])

    def least(self, floor: np.ndarray, rows, cols) -> np.ndarray:
        return floor - self.slack

    def below(self, score: np.ndarray) -> np.ndarray:
        """A bar that a score stays above however it is computed."""
        return score - 1.01 * 10.0 ** -self.digits

    def dense(self, rows, cols) -> np.ndarray:
        return np.round(self.a[rows] @ self.b[cols].T, self.digits)

    def pairs(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        return np.round(products(self.a, self.b, rows, cols), self.digits)


class Best:
    """The ``k`` best columns of each row: ``score`` and ``at`` (rank of the column; ``NONE`` where fewer were met)."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.score, self.at = np.full((n, k), -np.inf), np.full((n, k), NONE)
        self.floor = np.full(n, -np.inf) if floor is None else floor

    def put(self, rows: np.ndarray, ranks: np.ndarray, scores: np.ndarray) -> None:
        """Columns met by ``rows``; of a row's equal scores the smaller rank is kept."""
        touched = np.unique(rows)
        rows = np.concatenate([np.repeat(touched, self.k), rows])
        scores = np.concatenate([self.score[touched].ravel(), scores])
        ranks = np.concatenate([self.at[touched].ravel(), ranks])
        order = np.lexsort((ranks, -scores, rows))
        rows, scores, ranks = rows[order], scores[order], ranks[order]
        starts = np.searchsorted(rows, touched)
        kept = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows)))) < self.k
        self.score[touched], self.at[touched] = scores[kept].reshape(-1, self.k), ranks[kept].reshape(-1, self.k)
        self.floor[touched] = np.maximum(self.floor[touched], self.score[touched, -1])


def best_rows(scores, segments: Segments, k: int, rank: np.ndarray | None = None, floor: np.ndarray | None = None, only: bool = False) -> Best:
    """The ``k`` best columns of each row; equal scores go to the smaller ``rank`` of the column. ``floor``: what a score has to reach.

    ``only``: of the lists that a row visits, where others would change the result.
    """
    only = only and segments.met is not None
    best = Best(segments.n, k, floor)
    for i, upto, columns in segments:
        waiting, n = [], 0
        for rows, cols in columns:
            at = np.arange(rows.start, rows.stop) if isinstance(rows, slice) else rows
            open_ = np.isneginf(best.floor[at])
            if open_.any() and waiting:
                best.put(*map(np.concatenate, zip(*waiting)))
                waiting, n = [], 0
                open_ = np.isneginf(best.floor[at])
            if open_.any():  # rows with fewer than k so far: the best of a few columns are a first bar
                some = slice(cols.start, min(cols.start + max(48 * k, 256), cols.stop))
                floor_ = best.floor[at]
                if some.stop - some.start > k:
                    first = scores.dense(at[open_], some)
                    if only:
                        first[segments.shut(at[open_], some)] = -np.inf
                    floor_[open_] = scores.below(np.partition(first, -k, axis=1)[:, -k])
            else:
                floor_ = best.floor[at]
            passed = reaching(scores.rough(rows, cols), scores.least(floor_, at, cols))
            count = np.count_nonzero(passed)
            if not count:
                continue
            if count > DENSE * passed.size and count > 4 * k * len(at):
                exact = scores.dense(rows, cols)
                if only:
                    exact[segments.shut(at, cols)] = -np.inf
                ranks = np.arange(cols.start, cols.stop) if rank is None else rank[cols]
                last, last_at = floor_[:, None], np.where(best.score[at, -1] == floor_, best.at[at, -1], NONE)[:, None]
                r, c = np.nonzero((exact > last) | ((exact == last) & (ranks[None, :] < last_at)))
                r, c = (x[~np.isneginf(exact[r, c])] for x in (r, c))
                found = exact[r, c]
            else:
                r, c = places(passed)
                if only:
                    asked = segments.holds(at[r], c + cols.start)
                    r, c = r[asked], c[asked]
                found = scores.pairs(at[r], c + cols.start)
                good = found >= floor_[r]
                r, c, found = r[good], c[good], found[good]
            if len(r):
                waiting.append((at[r], (c + cols.start) if rank is None else rank[c + cols.start], found))
                n += len(r)
            if n >= k * (upto - i):
                best.put(*map(np.concatenate, zip(*waiting)))
                waiting, n = [], 0
        if waiting:
            best.put(*map(np.concatenate, zip(*waiting)))
    return best


class Near:
    """Which rows of two sets are within ``eps`` of each other."""

    def __init__(self, a: np.ndarray, b: np.ndarray, eps: float):
        self.a, self.b, self.eps = a, b, eps
        middle = b.mean(axis=0) if len(b) else np.zeros(a.shape[1])
        a, b = a - middle, b - middle  # shorter rows are off by less
        squares = [(m * m).sum(1).max(initial=0.0) for m in (a, b)]
        # Of the sum in single precision and of the bar; roots and squares differ by a little more.
        self.slack = (a.shape[1] + 12) * 2.0 ** -23 * (2 * np.sqrt(np.prod(squares)) + squares[1]) + 2.0 ** -22 * (squares[0] + eps * eps) + 1e-12 * (1 + eps * eps)
        # 2 x.y - |y|^2 >= |x|^2 - eps^2, the length of y as one more dimension
        self.x = np.concatenate([2 * a, np.full((len(a), 1), -1.0)], axis=1).astype(np.float32)
        self.y = np.concatenate([b, (b * b).sum(1)[:, None]], axis=1).astype(np.float32)
        self.bar = (a * a).sum(1) - eps * eps

    def settled(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """Near or not, by the formula of ``blocks.distances``."""
        squares = (np.einsum("ij,ij->i", m[at], m[at]) for m, at in ((self.a, rows), (self.b, cols)))
        return np.sqrt(np.maximum(sum(squares) - 2.0 * products(self.a, self.b, rows, cols), 0.0)) <= self.eps

    def pairs(self, rows, cols) -> tuple[np.ndarray, np.ndarray]:
        """The near pairs of a tile, as rows and columns of the blocks; ``rows`` and ``cols`` are slices or numbers."""
        at, to = (np.arange(s.start, s.stop) if isinstance(s, slice) else s for s in (rows, cols))
        rough = product(self.x[rows], self.y[cols])
        bar = self.bar[at]
        r, c = places(reaching(rough, bar - self.slack))
        unsure = np.flatnonzero(rough[r, c] < bar[r] + self.slack)
        if len(unsure):
            far = unsure[~self._settled(at[r[unsure]], to[c[unsure]])]
            keep = np.ones(len(r), bool)
            keep[far] = False
            r, c = r[keep], c[keep]
        return at[r], to[c]

    def _settled(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        return np.concatenate([self.settled(rows[i:i + SETTLED], cols[i:i + SETTLED]) for i in range(0, len(rows), SETTLED)])

    def counts(self, rows, cols: slice) -> np.ndarray:
        """How many of ``cols`` are near, per row."""
        at = np.arange(rows.start, rows.stop) if isinstance(rows, slice) else rows
        rough = product(self.x[rows], self.y[cols])
        bar = self.bar[at]
        high, low = (_per_row(reaching(rough, bar + off)) for off in (self.slack, -self.slack))
        for i in np.flatnonzero(low != high):
            c = np.flatnonzero(rough[i] >= np.float32(bar[i] - self.slack))
            unsure = rough[i, c] < np.float32(bar[i] + self.slack)
            high[i] += self._settled(np.full(unsure.sum(), at[i]), c[unsure] + cols.start).sum()
        return high


def _per_row(full: np.ndarray) -> np.ndarray:
    """How many are true in each row: bytes are added up eight at a time, fewer than 256 of them."""
    return full.view(np.uint64).sum(axis=1, dtype=np.uint64).view(np.uint8).reshape(len(full), 8).sum(axis=1, dtype=np.int64)
