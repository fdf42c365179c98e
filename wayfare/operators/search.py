"""Filtered nearest-neighbour search for many queries at once, with the fallback plan."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.operators.blocks import in_groups, listed_blocks, matrix, met_lists, ranks, unit_rows, vectors, visits, whole_join
from wayfare.operators.features import mean_vector
from wayfare.operators.nearest import NONE, Best, Cosines, Segments, best_rows
from wayfare.operators.reviews import cap_per_group
from wayfare.session import cut_lineage

TOP_K = 5
SCORE_DIGITS = 6
# Scores are rounded before they are ranked; a bound this close still counts.
SLACK = 2e-6
#: Rows whose cells are found at a time.
VISIT_ROWS = 512


def cell_count(n: int) -> int:
    """Cells for a corpus of ``n`` rows: about the square root, so centres and rows per cell grow alike."""
    return max(2, math.isqrt(n))


def in_order(block: pa.Table, lists: str = "_list") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a block in the order of their lists (one, if it has none) and ids, the rank of their ids, and where lists end."""
    by_id = ranks(block["id"])
    at = block[lists].to_numpy() if lists in block.column_names else np.zeros(len(block), int)
    order = np.lexsort((by_id, at))
    return order, by_id[order], np.flatnonzero(np.diff(at[order], append=-1)) + 1


def found_pairs(best: Best, l: pa.Table, r: pa.Table) -> dict:
    """The best pairs as columns."""
    rows, entry = np.nonzero(best.at != NONE)
    by_id = np.argsort(ranks(r["id"]), kind="stable")
    return {"query_id": l["query_id"].take(pa.array(rows)), "id": r["id"].take(pa.array(by_id[best.at[rows, entry]])), "score": best.score[rows, entry]}


def _best_in_block(k: int):
    """The best rows of a block for each query: of all, or of the lists that it visits, above ``floor`` where the queries have one."""
    def best(_, l: pa.Table, r: pa.Table, kind: pa.Schema) -> pa.Table:
        order, rank, ends = in_order(r)
        scores = Cosines(unit_rows(vectors(l["query_vector"])), unit_rows(vectors(r["vector"])[order]), SCORE_DIGITS)
        met = None
        if "_bits" in l.column_names:
            met = met_lists(b"".join(l["_bits"].to_pylist()), len(l), r["_list"].to_numpy()[order][ends - 1])
        floor = l["floor"].fill_null(-np.inf).to_numpy().copy() if "floor" in l.column_names else None
        # Cells that were visited before must not give their rows again.
        found = best_rows(scores, Segments(len(l), len(r), met, ends), k, rank, floor, only=True)
        return pa.table(found_pairs(found, l, r)).cast(kind)

    return best


def top_k(queries: DataFrame, corpus: DataFrame, filters: Sequence[str], k: int = TOP_K, rows: int | None = None) -> DataFrame:
    """The ``k`` most similar corpus rows per query among those with equal filter values (cosine, exact).

    ``queries(query_id, query_vector, filters...)``, ``corpus(id, vector, filters...)``;
    ids are of any type that Spark can order. The filter values cut the corpus
    before any scoring; what is left meets block by block. Equal scores go to
    the smaller id.
    """
    asked = queries.select("query_id", "query_vector", *filters)
    stored = corpus.select("id", "vector", *filters)
    kinds = dict(asked.dtypes), dict(stored.dtypes)
    schema = f"query_id {kinds[0]['query_id']}, id {kinds[1]['id']}, score double"
    partial = whole_join(asked, stored, filters, ("query_id", "id"), _best_in_block(k), schema, rows, by_bytes=True)
    return cap_per_group(partial, ["query_id"], [F.col("score").desc(), F.col("id")], k, rank="match_rank")


def city_vectors(corpus: DataFrame, city: str) -> DataFrame:
    """Stand-in for the vector of a city's name: the mean of the city's vectors."""
    return mean_vector(corpus, [city], "vector", "query_vector")


def top_k_with_fallback(queries: DataFrame, corpus: DataFrame, city: str, extra: Sequence[str], k: int = TOP_K) -> DataFrame:
    """Search with all filters; a query without any match is asked again by city alone with the city's vector."""
    first = top_k(queries, corpus, [city, *extra], k).withColumn("used_fallback", F.lit(False))
    keys = corpus.select(city, *extra).distinct()
    unmatched = queries.select("query_id", city, *extra).join(keys, [city, *extra], "left_anti").select("query_id", city)
    # Equal cities give the same answer, so each city is searched once.
    vectors = city_vectors(corpus, city)
    numbered = unmatched.groupBy(city).agg(F.min("query_id").alias("first_query")).join(vectors, city)
    by_city = top_k(numbered.withColumnRenamed("first_query", "query_id"), corpus, [city], k)
    again = (
        by_city.withColumnRenamed("query_id", "first_query").join(numbered.select("first_query", city), "first_query")
        .join(unmatched, city).select("query_id", "id", "score", "match_rank").withColumn("used_fallback", F.lit(True))
    )
    return first.unionByName(again)


def with_metadata(found: DataFrame, corpus: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Search results as id, score and the metadata of the match."""
    return found.join(corpus.select("id", F.struct(*columns).alias("metadata")), "id")


def fit_cells(corpus: DataFrame, n_cells: int, seed: int = 42) -> np.ndarray:
    """Centres of coarse cells over unit vectors (n_cells x dim, small by choice of n_cells)."""
    unit = corpus.select(array_to_vector(_unit(F.col("vector"))).alias("features"))
    model = KMeans(k=n_cells, seed=seed, maxIter=10, featuresCol="features").fit(unit)
    return unit_rows(np.stack(model.clusterCenters()))


def _unit(vector):
    """``vector`` scaled to length 1. The length is bound to a name: written out in the inner step, it would be summed up once per element."""
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x))
    return F.get(F.transform(F.array(length), lambda n: F.transform(vector, lambda x: F.when(n > 0, x / n).otherwise(0.0))), F.lit(0))


def with_cell(corpus: DataFrame, centres: np.ndarray) -> DataFrame:
    """The cell of each corpus row and the cosine to its centre. Store this as the searchable table."""
    @F.pandas_udf("cell int, closeness double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        if len(vectors) == 0:
            return pd.DataFrame({"cell": [], "closeness": []})
        cosine = unit_rows(matrix(vectors)) @ centres.T
        return pd.DataFrame({"cell": cosine.argmax(axis=1), "closeness": cosine.max(axis=1)})

    return corpus.withColumn("_c", nearest("vector")).select(*corpus.columns, "_c.*")


def _cells(centres: np.ndarray, reach: np.ndarray, probes: int, rest: bool):
    """For rows and their floors, the cells from near to far and which of them to visit (rows x cells)."""
    def cells(m: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cosine = np.clip(unit_rows(m) @ centres.T, -1.0, 1.0)
        order = np.argsort(-cosine, axis=1, kind="stable").astype(np.int32)
        if rest:
            best = np.cos(np.maximum(np.arccos(cosine) - reach[None, :], 0.0))
            met = best >= floor[:, None] - SLACK
        else:
            met = np.zeros(cosine.shape, bool)
        np.put_along_axis(met, order[:, :probes], not rest, axis=1)
        return order, met

    return cells


def cells_to_visit(centres: np.ndarray, reach: np.ndarray, probes: int, rest: bool):
    """Cells nearest to a query, or (``rest``) the further cells that may still hold a row above ``floor``.

    A row of a cell is at most ``reach`` away from the centre in angle, so its
    cosine to the query cannot pass cos(angle to centre - reach).
    """
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def cells(vectors: pd.Series, floor: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype=object)
        order, met = _cells(centres, reach, probes, rest)(matrix(vectors), floor.fillna(-2.0).to_numpy())
        return pd.Series([row[open_row[row]] for row, open_row in zip(order, met)])

    return cells


def _visiting(queries: DataFrame, centres: np.ndarray, reach: np.ndarray, probes: int, rest: bool) -> DataFrame:
    """``queries`` with the cells to visit, as bits: the same cells as those of ``cells_to_visit``."""
    @F.pandas_udf("binary")
    def cells(vectors: pd.Series, floor: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype=object)
        m, floor = matrix(vectors), floor.fillna(-2.0).to_numpy()
        to_visit = _cells(centres, reach, probes, rest)
        return in_groups(np.concatenate([to_visit(m[i:i + VISIT_ROWS], floor[i:i + VISIT_ROWS])[1] for i in range(0, len(m), VISIT_ROWS)]))

    return queries.withColumn("_all", cells("query_vector", "floor")).withColumn("_visits", visits(F.col("_all"), len(centres))).drop("_all")


def top_k_by_cells(queries: DataFrame, stored: DataFrame, centres: np.ndarray, filters: Sequence[str] = (),
                   k: int = TOP_K, probes: int = 4) -> DataFrame:
    """The same result as ``top_k`` with less scoring where the corpus falls into tight cells.

    ``stored`` comes from ``with_cell``. The nearest cells are scored first; the
    k-th score so far then rules out every cell that cannot reach it, and the
    remaining cells are scored too. ``probes`` moves work between the two steps
    and never changes the result.
    """
    reach = np.zeros(len(centres))
    for row in stored.groupBy("cell").agg(F.min("closeness").alias("c")).collect():
        reach[row.cell] = np.arccos(np.clip(row.c, -1.0, 1.0))
    asked = queries.select("query_id", "query_vector", *filters)
    corpus = stored.select("id", "vector", F.col("cell").alias("_list"), *filters)
    schema = f"query_id {dict(asked.dtypes)['query_id']}, id {dict(corpus.dtypes)['id']}, score double"

    def best(visiting):
        found = listed_blocks(visiting, corpus, filters, ("query_id", "id"), _best_in_block(k), schema)
        return cap_per_group(found, ["query_id"], [F.col("score").desc(), F.col("id")], k)

    first = cut_lineage(best(_visiting(asked.withColumn("floor", F.lit(None).cast("double")), centres, reach, probes, rest=False)))
    floor = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    second = best(_visiting(asked.join(floor, "query_id", "left"), centres, reach, probes, rest=True))
    found = first.unionByName(second)
    return cap_per_group(found, ["query_id"], [F.col("score").desc(), F.col("id")], k, rank="match_rank")
