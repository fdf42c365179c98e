"""Sets of hashed word shingles and their circulant MinHash keys, in numpy."""

from __future__ import annotations

from hashlib import md5

import numpy as np
import xxhash

#: Bands of rows: at a similarity of 0.75 a pair misses all bands with chance (1 - 0.75**4)**32 = 5e-6.
BANDS = 32
ROWS = 4
#: Coordinates of which the lowest byte is kept to estimate a similarity; the bands use the first BANDS * ROWS of them.
SKETCH = 512
#: Estimates have a deviation of 0.019 at 0.75; a pair this far below the threshold is out (chance of an error: 3e-6).
MARGIN = 0.087
WORDS = 5
_CHUNK = 1 << 15
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_U32 = np.uint32


class WordHashes(dict):
    """word -> 64-bit hash, remembered; starts anew when it gets large."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; a text with fewer words has one, of all of them.

    Words are runs of anything but ASCII white space, with A-Z lower-cased: just
    what ``bytes.lower`` and ``bytes.split`` do.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    take = min(size, len(words))
    value = np.zeros(len(words) - take + 1, np.uint64)
    for j in range(take):
        value = value * _MULTIPLY + hashes[j:j + len(value)]
    return np.unique(mixed(value + np.uint64(take)))


def digest(found: np.ndarray) -> bytes:
    return md5(found.tobytes()).digest()


def signatures(sets: list[np.ndarray], coordinates: int = SKETCH) -> np.ndarray:
    """Circulant MinHash of non-empty sets, one row each.

    The universe are the 32-bit numbers. The first permutation (sigma) places an
    element once; coordinate k is the smallest value that the second (pi) gives
    to the places shifted circularly by k. Sigma and pi are bijections of the
    universe, so two permutations make all coordinates.
    """
    out = np.zeros((len(sets), coordinates), np.uint32)
    at = 0
    while at < len(sets):
        end, total = at, 0
        while end < len(sets) and (end == at or total + len(sets[end]) <= _CHUNK):
            total += len(sets[end])
            end += 1
        sizes = np.fromiter(map(len, sets[at:end]), np.int64, end - at)
        starts = np.cumsum(sizes) - sizes
        place = (np.concatenate(sets[at:end]) >> np.uint64(32)).astype(np.uint32)
        place = (place ^ (place >> _U32(16))) * _U32(0x7FEB352D)  # sigma
        place = (place ^ (place >> _U32(15))) * _U32(0x846CA68B)
        place ^= place >> _U32(16)
        shifted, other = np.empty_like(place), np.empty_like(place)
        for k in range(coordinates):
            np.add(place, _U32((k * 0x9E3779B1) & 0xFFFFFFFF), out=shifted)  # the circular shift: sums wrap around
            np.right_shift(shifted, _U32(16), out=other)  # pi
            np.bitwise_xor(shifted, other, out=shifted)
            np.multiply(shifted, _U32(0x85EBCA6B), out=shifted)
            np.right_shift(shifted, _U32(13), out=other)
            np.bitwise_xor(shifted, other, out=shifted)
            np.multiply(shifted, _U32(0xC2B2AE35), out=shifted)
            out[at:end, k] = np.minimum.reduceat(shifted, starts)
        at = end
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band; keys of different bands never meet but by chance."""
    parts = signature[:, :bands * rows].reshape(len(signature), bands, rows).astype(np.uint64)
    value = np.zeros((len(signature), bands), np.uint64)
    for j in range(rows):
        value = mixed(value * _MULTIPLY + parts[:, :, j] + np.uint64(1))
    return mixed(value + np.arange(bands, dtype=np.uint64)[None, :] * _MULTIPLY).view(np.int64)


def estimates(sketches: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of the pairs (a, b) of sketch rows; unequal values share their lowest byte 1 time in 256."""
    out = np.zeros(len(a))
    for at in range(0, len(a), 4096):
        same = (sketches[a[at:at + 4096]] == sketches[b[at:at + 4096]]).mean(axis=1)
        out[at:at + 4096] = (same - 1 / 256) / (1 - 1 / 256)
    return out


def alike(a: bytes, b: bytes, percent: int = 75) -> bool:
    """Whether 100 * intersection >= percent * union, of two sets as bytes."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    if len(x) > len(y):
        x, y = y, x
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    inter = int((both[1:] == both[:-1]).sum())
    return 100 * inter >= percent * (len(x) + len(y) - inter)
