"""Periodic runs of words by internal pattern matching.

A run of period q is at least three periods (and 24 words) long, so it holds a
block of 2**k words, placed at a multiple of 2**k, that stands again q words
further on, where 2**k <= q < 2**(k+1) (k = 3 also for smaller q). A suffix array
gives each such block its interval of suffixes, a wavelet matrix over that array
tells how often, and where first and last, the block stands in the next window.
Up to two places are candidate periods themselves. More of them stand a fixed
step apart; their stretch and the block's own stretch of that step then have to
lie one period apart at one end, or the step itself is the period, which leaves
three candidates however many places there are. Candidates are extended to both
sides and counted where they are long enough; of those that cover the same words
the smallest period is the run's.

Texts are handled many at a time, as one sequence in which the words of one text
are different from those of another. Memory is some bytes per word and doubling
step, of one slice of texts or one longer text.

Results in odd cases: a text without words has no run, and so has a null one; a
null id plants nothing; equal rows give equal results; an empty table gives no
rows; other columns are not looked at. Ids are whole numbers.
"""

from __future__ import annotations

from fractions import Fraction
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import slices, table
from wayfare.llm.suffixes import Suffixes, Wavelet

#: A run has so many words, and so many periods, at least.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Blocks of 2**BASE words find all periods below 2**(BASE + 1): LEAST_WORDS less such a period holds a whole block.
BASE = 3
#: Texts are put into one sequence until it has so many words.
SLICE_WORDS = 1 << 17


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the period that a tenth of the ids plant."""
    n = len(words)
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    turn = words[a:a + p]
    return words[:a] + (turn * -(-(n - a) // p))[:n - a]


def _sequence(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All words as numbers, each text followed by a number of its own; and where texts begin."""
    parts, begins, top, at = [], [], 0, 0
    for words in texts:
        seen: dict[bytes, int] = {}
        parts.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)) + top)
        top += len(seen)
        parts.append(np.array([top], np.int64))
        top += 1
        begins.append(at)
        at += len(words) + 1
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), np.array([*begins, at], np.int64)


def _windows(suffixes: Suffixes, begins: np.ndarray):
    """(places of blocks, their intervals, first and last start to look at, block length), level by level."""
    for k in range(BASE, len(suffixes.ranks)):
        at, sizes, m = suffixes.active[k], suffixes.sizes[k], 1 << k
        text = np.searchsorted(begins, at, "right") - 1
        grid = (at - begins[text]) % m == 0
        at, sizes = at[grid].astype(np.int64), sizes[grid]
        low = suffixes.ranks[k][at].astype(np.int64)
        if k == BASE:
            yield at, low, low + sizes, at + 1, at + m, m
        yield at, low, low + sizes, at + m, at + 2 * m - 1, m


def candidates(suffixes: Suffixes, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs that between them meet every run; a place and the one a period further on begin alike."""
    none = np.zeros(0, np.int64)
    if len(suffixes.ranks) <= BASE or not len(suffixes.active[BASE]):
        return none, none
    array = suffixes.array()
    kept = np.zeros(suffixes.n, bool)  # only suffixes whose first 2**BASE words stand elsewhere too are asked for
    kept[suffixes.ranks[-1][suffixes.active[BASE]]] = True
    narrow = np.concatenate([[0], np.cumsum(kept)])
    tree = Wavelet(array[kept], suffixes.n.bit_length())
    places, periods = [none], [none]
    for at, low, high, first, last, m in _windows(suffixes, begins):
        low, high = narrow[low], narrow[high]
        before = tree.below(low, high, first)
        count = tree.below(low, high, last + 1) - before
        held = np.flatnonzero(count > 0)
        at, low, high, before, count = at[held], low[held], high[held], before[held], count[held]
        one = tree.smallest(low, high, before)
        end = tree.smallest(low, high, before + count - 1)
        few = count < 3
        places += [at[few], at[few]]
        periods += [one[few] - at[few], end[few] - at[few]]
        at, low, high, before, one, end = (x[~few] for x in (at, low, high, before, one, end))
        if not len(at):
            continue
        step = tree.smallest(low, high, before + 1) - one
        for ends in (lambda x: x - suffixes.behind(x, x + step), lambda x: x + suffixes.ahead(x, x + step)):
            places.append(at)
            periods.append(ends(one) - ends(at))
        places.append(at)
        periods.append(step)
    place, period = np.concatenate(places), np.concatenate(periods)
    real = (period > 0) & (place + period < suffixes.n)
    return place[real], period[real]


def runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """(start, length, period) rows of each text's runs, by start, then period."""
    symbols, begins = _sequence(texts)
    suffixes = Suffixes(symbols)
    place, period = candidates(suffixes, begins)
    pairs = np.unique(np.stack([place, period], 1), axis=0) if len(place) else np.zeros((0, 2), np.int64)
    place, period = pairs[:, 0], pairs[:, 1]
    start = place - suffixes.behind(place, place + period)
    length = place + period + suffixes.ahead(place, place + period) - start
    long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    found = np.stack([start, length, period], 1)[long]
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(1)  # the smallest period of each stretch
    found = found[new]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    cuts = np.searchsorted(found[:, 0], begins)
    return [found[a:b] - [begin, 0, 0] for a, b, begin in zip(cuts, cuts[1:], begins)]


def collapsed(words: list[bytes], found: np.ndarray) -> bytes:
    """The words without those that a run has after its first period."""
    if len(found):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, found[:, 0] + found[:, 2], 1)
        np.add.at(change, found[:, 0] + found[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words)


def summary(words: list[bytes], found: np.ndarray) -> tuple:
    rows = found.tolist()
    best = max(rows, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if rows else None
    return (
        len(rows), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        sha256("".join(f"{s},{n},{q}\n" for s, n, q in rows).encode()).hexdigest(), sha256(collapsed(words, found)).hexdigest())


def find(docs: DataFrame, plant: bool = False, slice_words: int = SLICE_WORDS) -> DataFrame:
    """Runs per document, the strongest of them, and digests of all runs and of the collapsed words.

    ``plant`` first writes a period into a tenth of the documents, chosen by a digest of their id.
    """
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    schema = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int64()) for n in names])

    def ready(held):
        rows = [(d, *summary(words, found)) for (d, words), found in zip(held, runs([w for _, w in held]))]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches):
        held, size = [], 0
        for batch in slices(batches):
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = (text or b"").split()  # bytes are cut at the white space of ASCII only
                held.append((doc_id, planted(words, doc_id) if plant else words))
                size += len(words) + 1
                if size >= slice_words:
                    yield ready(held)
                    held, size = [], 0
        if held:
            yield ready(held)

    ddl = ", ".join(f"{n} {'string' if n.endswith('sha256') else 'long'}" for n in names)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, ddl)


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), plant=True)
