"""Gradient-boosted trees in numpy: histogram training, monotonic constraints, flat node arrays for scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """All trees as flat arrays: one entry per node; a leaf has itself as both children."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds per row; every tree and row takes a step down at once."""
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        for _ in range(self.depth):
            go_left = np.take_along_axis(x, self.feature[at], axis=1) <= self.cut[at]
            at = np.where(go_left, self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)


def train(
    x: np.ndarray, y: np.ndarray, monotone: dict[int, int], trees: int = 60, depth: int = 3, rate: float = 0.2,
    bins: int = 64, ridge: float = 1.0, least_rows: int = 5,
) -> Forest:
    """Boosting on the logistic loss.

    ``monotone`` maps a feature to +1 or -1: a split there must not order its
    children's values against the sign, and each child's values stay on its side
    of the middle between them, so the constraint holds for the whole tree.
    """
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) if n else np.zeros(0)
            for j in range(width)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(width)], 1) if n else x.astype(int)
    share = min(max((y.sum() + 1.0) / (n + 2.0), 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    margin = np.full(n, base)
    nodes: list[list] = []
    roots = []
    for _ in range(trees if n else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        roots.append(len(nodes))
        nodes.append([0, np.inf, len(nodes), len(nodes), 0.0])
        open_nodes = [(roots[-1], np.arange(n), -np.inf, np.inf)]
        for level in range(depth + 1):
            following = []
            for node, rows, low, high in open_nodes:
                g, h = grad[rows].sum(), hess[rows].sum()
                best = None
                if level < depth and len(rows) >= 2 * least_rows:
                    for j in range(width):
                        size = len(cuts[j]) + 1
                        if size < 2:
                            continue
                        column = binned[rows, j]
                        gl = np.cumsum(np.bincount(column, grad[rows], size))[:-1]
                        hl = np.cumsum(np.bincount(column, hess[rows], size))[:-1]
                        nl = np.cumsum(np.bincount(column, minlength=size))[:-1]
                        wl = np.clip(-gl / (hl + ridge), low, high)
                        wr = np.clip(-(g - gl) / (h - hl + ridge), low, high)
                        gain = gl ** 2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g ** 2 / (h + ridge)
                        fine = (nl >= least_rows) & (len(rows) - nl >= least_rows)
                        if j in monotone:
                            fine &= (wr - wl) * monotone[j] >= 0
                        gain = np.where(fine, gain, -np.inf)
                        k = int(np.argmax(gain))
                        if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                            best = (gain[k], j, k, wl[k], wr[k])
                if best is None:
                    nodes[node][4] = rate * float(np.clip(-g / (h + ridge), low, high))
                    margin[rows] += nodes[node][4]
                    continue
                _, j, k, wl, wr = best
                goes = binned[rows, j] <= k
                bounds = [(low, high), (low, high)]
                if j in monotone:
                    middle = (wl + wr) / 2
                    bounds = [(low, middle), (middle, high)] if monotone[j] > 0 else [(middle, high), (low, middle)]
                nodes[node][:4] = [j, float(cuts[j][k]), len(nodes), len(nodes) + 1]
                for part, (a, b) in zip((rows[goes], rows[~goes]), bounds):
                    following.append((len(nodes), part, a, b))
                    nodes.append([0, np.inf, len(nodes), len(nodes), 0.0])
            open_nodes = following
    columns = list(zip(*nodes)) or [[]] * 5
    return Forest(
        np.array(columns[0], np.int64), np.array(columns[1], float), np.array(columns[2], np.int64),
        np.array(columns[3], np.int64), np.array(columns[4], float), np.array(roots, np.int64), depth, base)
