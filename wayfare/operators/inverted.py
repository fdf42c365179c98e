"""Approximate nearest neighbours under filters: inverted lists of short codes, re-ranked by the vectors themselves.

The corpus is dealt to lists around coarse centres; what a row's unit vector
differs from its centre is kept as one byte per few dimensions (product
quantisation). A list is kept apart by filter value, so a filter cuts the lists
before anything is scored. A query visits the lists nearest to it among those of
its filter values, as many as measured to be needed, scores their codes, and
only its best rows by code are scored by their vectors.

With about the square root of the corpus as the number of lists, a query scores
rows in proportion to that root where vectors lie in groups. Where they do not
(independent random vectors), ``calibrate`` finds that most lists are needed and
says so by the number it returns; recall is kept and the saving is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators.blocks import distances, equal_rows, matrix, ranks, unit_rows, vectors, whole_join
from wayfare.operators.nearest import NONE, SETTLED, Segments, best_rows, product, products
from wayfare.operators.reviews import cap_per_group
from wayfare.operators.search import SCORE_DIGITS, TOP_K, VISIT_ROWS, cell_count, fit_cells, in_order, top_k
from wayfare.session import cut_lineage

#: Rows that centres are fitted to, per list; Spark keeps them.
ROWS_PER_LIST = 64
#: Rows that the code books are fitted to, and queries that the number of lists is measured with; these come to the driver.
BOOK_ROWS, CALIBRATION_ROWS = 10_000, 256
#: Dimensions per byte of a code, and entries of a code book.
DIMS_PER_CODE, CODES = 4, 256
#: Share of the true neighbours whose lists have to be visited.
LIST_RECALL = 0.98
#: Rows scored by their vectors, per result.
DEPTH = 10
#: Lists of a filter value are looked up in so many salted copies, so that a frequent value is no single key.
SALTS = 16
#: Queries whose rows found are looked up at a time.
LOOKED_UP = 8192


@dataclass(frozen=True)
class Index:
    """Fitted centres (lists x dimensions), code books (codes x entries x dimensions each), and the stored rows."""

    centres: np.ndarray
    books: np.ndarray
    rows: DataFrame  # id, filters..., list, code
    lists: DataFrame  # filters..., lists, sizes: one row per filter values
    filters: tuple[str, ...]


def _sample(df: DataFrame, rows: int, n: int) -> DataFrame:
    """About ``rows`` of ``n`` rows, the same ones in every run."""
    return df if n <= rows else df.filter(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) < int(rows / n * (1 << 30)))


def _parts(m: np.ndarray) -> np.ndarray:
    """Rows cut into groups of dimensions (codes x rows x dimensions each), filled up with zeros."""
    width = -(-m.shape[1] // DIMS_PER_CODE)
    full = np.zeros((len(m), width * DIMS_PER_CODE))
    full[:, :m.shape[1]] = m
    return full.reshape(len(m), width, DIMS_PER_CODE).transpose(1, 0, 2)


def _book(points: np.ndarray, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """A code book of one group of dimensions by Lloyd's steps; entries that lose all points stay where they are."""
    centres = points[rng.choice(len(points), CODES, replace=len(points) < CODES)]
    for _ in range(rounds):
        nearest = distances(points, centres).argmin(axis=1)
        counts = np.bincount(nearest, minlength=CODES)[:, None]
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
    return centres


def _placed(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each row, and the unit vector's difference from it."""
    unit = unit_rows(vectors)
    at = (unit @ centres.T).argmax(axis=1)
    return at, unit - centres[at]


def build(corpus: DataFrame, filters: Sequence[str], n_lists: int | None = None, seed: int = 42) -> Index:
    """Fit centres and code books to bounded samples, then store every row of ``corpus(id, vector, filters...)``."""
    n = corpus.count()
    n_lists = n_lists or cell_count(n)
    centres = fit_cells(_sample(corpus, n_lists * ROWS_PER_LIST, n), n_lists, seed)
    rows = _sample(corpus, BOOK_ROWS, n).select("vector").limit(2 * BOOK_ROWS).toPandas()
    rng = np.random.default_rng(seed)
    books = np.stack([_book(part, rng) for part in _parts(_placed(matrix(rows["vector"]), centres)[1])])

    @F.pandas_udf("list int, code binary")
    def encode(vectors: pd.Series) -> pd.DataFrame:
        if len(vectors) == 0:
            return pd.DataFrame({"list": [], "code": []})
        at, rest = _placed(matrix(vectors), centres)
        codes = np.stack([distances(part, book).argmin(axis=1) for part, book in zip(_parts(rest), books)], axis=1)
        return pd.DataFrame({"list": at, "code": [row.tobytes() for row in codes.astype(np.uint8)]})

    stored = cut_lineage(corpus.select("id", *filters, encode("vector").alias("_e")).select("id", *filters, "_e.*"))
    sizes = stored.groupBy(*filters, "list").agg(F.count("*").alias("n"))
    lists = cut_lineage(sizes.groupBy(*filters).agg(F.collect_list(F.struct("list", "n")).alias("l")).select(
        *filters, F.col("l.list").alias("lists"), F.col("l.n").alias("sizes")))
    return Index(centres, books, stored, lists, tuple(filters))


def _with_lists(index: Index, queries: DataFrame) -> DataFrame:
    """Queries with the lists that exist for their filter values; a query without any has no result."""
    salted = index.lists.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return queries.withColumn("_s", F.pmod(F.xxhash64("query_id"), F.lit(SALTS)).cast("int")).join(
        salted, [*index.filters, "_s"]).drop("_s")


def visiting(index: Index, queries: DataFrame, probes: int, least: int) -> DataFrame:
    """Queries with the lists to visit as bits (``_lists``): the nearest lists, ``probes`` of them or more until ``least`` rows are in them."""
    centres = index.centres

    @F.pandas_udf("binary")
    def nearest(vectors: pd.Series, lists: pd.Series, sizes: pd.Series) -> pd.Series:
        out = []
        for i in range(0, len(vectors), VISIT_ROWS):
            some = slice(i, i + VISIT_ROWS)
            cosine = unit_rows(matrix(vectors.iloc[some])) @ centres.T
            met = np.zeros(cosine.shape, bool)
            for row, at, n, mark in zip(cosine, lists.iloc[some], sizes.iloc[some], met):
                order = np.lexsort((at, -row[at]))
                before = np.cumsum(n[order]) - n[order]
                mark[at[order[(np.arange(len(order)) < probes) | (before < least)]]] = True
            out += [row.tobytes() for row in np.packbits(met, axis=1)]
        return pd.Series(out, dtype=object)

    return _with_lists(index, queries).select("query_id", "query_vector", *index.filters, nearest("query_vector", "lists", "sizes").alias("_lists"))


def visits(index: Index, queries: DataFrame, probes: int, least: int) -> DataFrame:
    """A row per query and list to visit, with the list's size."""
    filters = list(index.filters)

    @F.pandas_udf("array<int>")
    def numbers(bits: pd.Series) -> pd.Series:
        return pd.Series([np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8))).astype(np.int32) for b in bits], dtype=object)

    found = visiting(index, queries, probes, least).withColumn("list", F.explode(numbers("_lists"))).drop("_lists")
    sizes = index.lists.select(*filters, F.explode(F.arrays_zip("lists", "sizes")).alias("l")).select(
        *filters, F.col("l.lists").alias("list"), F.col("l.sizes").alias("n"))
    return found.join(sizes, [*filters, "list"]).select("query_id", "query_vector", *filters, "list", "n")


def calibrate(index: Index, corpus: DataFrame, k: int = TOP_K, recall: float = LIST_RECALL, rows: int = CALIBRATION_ROWS) -> int:
    """Lists a query has to visit so that ``recall`` of the true neighbours are in them, measured with a bounded sample of rows
    asked against the whole corpus."""
    filters = list(index.filters)
    asked = _sample(corpus, rows, corpus.count()).select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"), *filters)
    true = top_k(asked, corpus, filters, k).join(index.rows.select("id", "list"), "id").select("query_id", F.col("list").alias("wanted"))
    centres = index.centres

    @F.pandas_udf("int")
    def place(vectors: pd.Series, lists: pd.Series, wanted: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype="int32")
        cosine = unit_rows(matrix(vectors)) @ centres.T
        return pd.Series([int(np.flatnonzero(at[np.lexsort((at, -row[at]))] == w)[0]) for row, at, w in zip(cosine, lists, wanted)])

    places = _with_lists(index, asked.join(true, "query_id")).select(place("query_vector", "lists", "wanted").alias("p"))
    seen = sorted(places.groupBy("p").agg(F.count("*").alias("n")).collect())  # a row per place, at most as many as lists
    wanted, reached = recall * sum(r.n for r in seen), 0
    for r in seen:
        reached += r.n
        if reached >= wanted:
            return r.p + 1
    return 1


class Codes:
    """Products of unit rows with the vectors that codes stand for, for ``best_rows``; codes are opened tile by tile."""

    def __init__(self, a: np.ndarray, centres: np.ndarray, books: np.ndarray, lists: np.ndarray, codes: np.ndarray):
        self.a, self.centres, self.books, self.lists, self.codes = a, centres, books, lists, codes
        self.x, self.rough_centres, self.rough_books = (m.astype(np.float32) for m in (a, centres, books))
        longest = np.sqrt((books ** 2).sum(axis=2).max(axis=1).sum()) + 1.0  # of a centre and the rest
        self.slack = (centres.shape[1] + 10) * 2.0 ** -23 * longest

    def _near(self, cols, centres: np.ndarray, books: np.ndarray) -> np.ndarray:
        codes = self.codes[cols]
        return np.concatenate([book[codes[:, i]] for i, book in enumerate(books)], axis=1)[:, :centres.shape[1]] + centres[self.lists[cols]]

    def rough(self, rows, cols):
        return product(self.x[rows], self._near(cols, self.rough_centres, self.rough_books))

    def least(self, floor: np.ndarray, rows, cols) -> np.ndarray:
        return floor - self.slack

    def below(self, score: np.ndarray) -> np.ndarray:
        return score - 1e-9

    def dense(self, rows, cols) -> np.ndarray:
        return self.a[rows] @ self._near(cols, self.centres, self.books).T

    def pairs(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        parts = [np.einsum("ij,ij->i", self.a[rows[i:i + SETTLED]], self._near(cols[i:i + SETTLED], self.centres, self.books))
                 for i in range(0, len(rows), SETTLED)]
        return np.concatenate(parts) if parts else np.zeros(0)


def _lists_of(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], sizes.cumsum()]), pa.int32()), values)


def search(index: Index, queries: DataFrame, corpus: DataFrame, k: int = TOP_K, probes: int = 8, depth: int = DEPTH) -> DataFrame:
    """(query_id, id, score, match_rank): the best ``k`` rows found, by their exact cosine.

    ``queries(query_id, query_vector, filters...)``. Scores are those of
    ``search.top_k``; what may be missing are rows in lists not visited, or with
    more than ``k * depth`` rows better by code. Codes are short, so blocks of
    queries meet all of them in one task; vectors are met block by block, and
    never written beside each of the rows that were found.
    """
    filters, centres, books = list(index.filters), index.centres, index.books
    kept = k * depth
    kinds = dict(queries.dtypes)["query_id"], dict(corpus.dtypes)["id"]

    def by_code(_, l: pa.Table, r: pa.Table, kind: pa.Schema) -> pa.Table:
        order, rank, ends = in_order(r, "list")
        lists = r["list"].to_numpy()[order]
        codes = np.frombuffer(b"".join(r["code"].to_pylist()), np.uint8).reshape(len(r), -1)[order]
        bits = np.frombuffer(b"".join(l["_lists"].to_pylist()), np.uint8).reshape(len(l), -1)
        met = np.concatenate([np.unpackbits(bits[i:i + VISIT_ROWS], axis=1)[:, lists[ends - 1]].astype(bool) for i in range(0, len(l), VISIT_ROWS)])
        best = best_rows(Codes(unit_rows(vectors(l["query_vector"])), centres, books, lists, codes), Segments(len(l), len(r), met, ends), kept, rank, only=True)
        there = best.at != NONE
        by_id = np.argsort(ranks(r["id"]), kind="stable")
        ids, sizes = r["id"].take(pa.array(by_id[best.at[there]])).combine_chunks(), there.sum(axis=1)
        return pa.table({"query_id": l["query_id"], "ids": _lists_of(ids, sizes), "off": _lists_of(pa.array(-best.score[there]), sizes)}).cast(kind)

    found = whole_join(visiting(index, queries, probes, kept), index.rows, filters, ("query_id", "id"), by_code,
                       f"query_id {kinds[0]}, ids array<{kinds[1]}>, off array<double>", by_bytes=True)
    both = F.flatten(F.collect_list(F.arrays_zip("off", "ids")))
    wanted = found.groupBy("query_id").agg(F.slice(F.sort_array(both), 1, kept)["ids"].alias("ids"))

    def by_vector(_, l: pa.Table, r: pa.Table, kind: pa.Schema) -> pa.Table:
        a, b, rank = unit_rows(vectors(l["query_vector"])), unit_rows(vectors(r["vector"])), ranks(r["id"])
        parts = []
        for i in range(0, len(l), LOOKED_UP):
            ids = l["ids"].slice(i, LOOKED_UP).combine_chunks()
            ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
            of = i + np.repeat(np.arange(len(ids)), pc.list_value_length(ids).to_numpy())
            at, to = equal_rows(pa.chunked_array([ids.flatten()]), r["id"])
            rows = of[at]
            score = np.round(products(a, b, rows, to), SCORE_DIGITS)
            order = np.lexsort((rank[to], -score, rows))
            rows, to, score = rows[order], to[order], score[order]
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            best = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows)))) < k
            parts.append((rows[best], to[best], score[best]))
        rows, to, score = map(np.concatenate, zip(*parts))
        return pa.table({"query_id": l["query_id"].take(pa.array(rows)), "id": r["id"].take(pa.array(to)), "score": score}).cast(kind)

    asked = queries.select("query_id", "query_vector", *filters).join(wanted, "query_id")
    exact = whole_join(asked, corpus.select("id", "vector", *filters), filters, ("query_id", "id"), by_vector,
                       f"query_id {kinds[0]}, id {kinds[1]}, score double", by_bytes=True)
    return cap_per_group(exact, ["query_id"], [F.col("score").desc(), F.col("id")], k, rank="match_rank")


def recall(found: DataFrame, true: DataFrame) -> DataFrame:
    """(n_queries, n_true, n_found): how many of the true results were found; a row as good as the last true one counts as found."""
    last = true.groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n_true"))
    good = last.join(found.select("query_id", "score"), "query_id", "left").groupBy("query_id", "n_true").agg(
        F.least(F.count_if(F.col("score") >= F.col("floor")), "n_true").alias("n_found"))
    return good.agg(F.count("*").alias("n_queries"), F.sum("n_true").alias("n_true"), F.sum("n_found").alias("n_found"))
