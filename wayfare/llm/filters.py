"""Spherical-cap filters with random product codes, in numpy.

A filter is a direction made of one code word per block of (rotated)
coordinates; a vector belongs to every filter whose cap it lies in, and these
are found by list decoding: only code words that can still reach the cap's
height with the best of the other block are looked at. Several codes, each with
a rotation of its own, even out how many filters a vector gets from one of them.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SEED = 20
#: Codes, and filters of one code that two vectors at exactly the threshold share on average. Measured at dimension 64:
#: under 1 in 1,000 such pairs share none at all; higher cosines share more.
CODES = 8
SHARED = 4.0


@lru_cache(maxsize=2 * CODES)
def code(dimension: int, words: int, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random rotation and the unit code words of the two blocks of coordinates."""
    rng = np.random.default_rng([SEED, dimension, words, number])
    rotation = np.linalg.qr(rng.standard_normal((dimension, dimension)))[0]
    half = (dimension + 1) // 2
    blocks = [rng.standard_normal((words, n)) for n in (half, max(1, dimension - half))]
    return rotation, *(b / np.linalg.norm(b, axis=1, keepdims=True) for b in blocks)


@lru_cache(maxsize=64)
def height(dimension: int, words: int, cosine: float, shared: float = SHARED) -> float:
    """Height of the caps at which two vectors at ``cosine`` share ``shared`` filters on average.

    A random direction's coordinates (u, v) in the plane of the two vectors have
    density (1 - u^2 - v^2)^((d - 4) / 2); the share of it where both inner
    products reach the height is summed on a grid.
    """
    if dimension < 5:
        return -2.0  # too few dimensions for caps: all vectors of a label meet in every filter
    u, v = np.meshgrid(np.linspace(-1, 1, 1201), np.linspace(-1, 1, 1201), indexing="ij")
    density = np.maximum(1 - u * u - v * v, 0) ** ((dimension - 4) / 2)
    lower = np.minimum(u, cosine * u + np.sqrt(1 - cosine * cosine) * v).ravel()
    order = np.argsort(-lower)
    share = np.cumsum(density.ravel()[order]) / density.sum()
    at = int(np.searchsorted(share, min(1.0, shared / words ** 2)))
    return float(lower[order][min(at, len(order) - 1)])


def code_words(vectors: int) -> int:
    """Code words per block: about a filter for every few vectors, so that chance meetings stay few at any size."""
    need = max(256, int(np.ceil(np.sqrt(32.0 * max(1, vectors)))))
    return 1 << (need - 1).bit_length()


def decode(vectors: np.ndarray, words: int, least: float) -> list[np.ndarray]:
    """All filters whose cap of height ``least`` holds the vector, per unit vector."""
    dimension = vectors.shape[1]
    if dimension < 5:
        return [np.zeros(1, np.int64)] * len(vectors)
    each = [_decode(vectors, words, least, number) for number in range(CODES)]
    return [np.concatenate(parts) for parts in zip(*each)]


def _decode(vectors: np.ndarray, words: int, least: float, number: int) -> list[np.ndarray]:
    rotation, first, second = code(vectors.shape[1], words, number)
    turned = vectors @ rotation
    half = first.shape[1]
    a, b = turned[:, :half] @ first.T, turned[:, half:half + second.shape[1]] @ second.T
    goal = least * np.sqrt(2.0)
    base = number * words * words
    out = []
    for x, y in zip(a, b):
        rows = np.flatnonzero(x >= goal - y.max())
        order = np.argsort(-y)[:max(1, int((y >= goal - x.max()).sum()))]
        counts = np.searchsorted(-y[order], x[rows] - goal, side="right")
        picked = np.repeat(rows, counts)
        inner = np.arange(len(picked)) - np.repeat(np.cumsum(counts) - counts, counts)
        out.append(base + picked * words + order[inner])
    return out
