"""A metric index for joins within a distance: cells around pivots, cut into shells by the distance to the pivot.

Each row is stored once, in the cell of its nearest pivot and the shell of its
distance to it. A row that looks for others within eps goes to every cell and
shell that can hold one, which two bounds rule out, both exact:

* a row of shell s of pivot p is between s * width and (s + 1) * width away from
  p, and by the triangle inequality so is the looking row, give or take eps;
* between the pivots p and q lies the plane of points equally far from both. A
  looking row on q's side, further than eps from that plane, is further than eps
  from everything on p's side. Its distance to the plane follows from its
  distances to the pivots and theirs.

Where rows lie in groups further apart than eps, a row meets its own group.
Where they do not (independent random vectors, eps near their usual distance),
no bound of this kind rules anything out and all cells are met.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators.blocks import GROUPS, distances, in_groups, listed_blocks, listed_join, matrix, met_lists, vectors, visits
from wayfare.operators.nearest import Near, Segments

#: Rows per cell aimed at; more pivots than the bound are never used, cells and their blocks grow instead.
CELL_ROWS, MAX_PIVOTS = 256, 1024
#: Rows per pivot that pivots are chosen from; these come to the driver.
CHOICES = 8
#: Nearest pivots of a row whose planes are tried.
PLANES = 8
#: Shells of a cell; where the furthest row asks for more of width eps, they are wider.
MAX_SHELLS = 16
#: Rows whose reach is found at a time.
REACH_ROWS = 512
#: Distances are counted as closer by this share of their size, for rounding.
ROUNDING = 1e-7


@dataclass(frozen=True)
class Shells:
    pivots: np.ndarray
    between: np.ndarray  # distances of the pivots to each other
    width: float
    last: np.ndarray  # per pivot, the last shell that holds a row; -1 where none does

    @property
    def lists(self) -> int:
        """Shells of all cells."""
        return len(self.pivots) * (int(self.last.max()) + 1)


def choose(df: DataFrame, n: int, seed: int = 42) -> np.ndarray:
    """``n`` pivots from a bounded sample: each row is the further from those chosen before the likelier it is the next."""
    sample = df.select("id", "vector").orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(n * CHOICES).toPandas()
    points, rng = matrix(sample["vector"]), np.random.default_rng(seed)
    chosen = [points[0]]
    nearest = distances(points, points[:1])[:, 0] ** 2
    while len(chosen) < n and nearest.sum() > 0:
        chosen.append(points[rng.choice(len(points), p=nearest / nearest.sum())])
        nearest = np.minimum(nearest, distances(points, chosen[-1][None])[:, 0] ** 2)
    return np.stack(chosen)


def _place(pivots: np.ndarray, width: float):
    @F.pandas_udf("cell int, shell int")
    def place(vectors: pd.Series) -> pd.DataFrame:
        if len(vectors) == 0:
            return pd.DataFrame({"cell": [], "shell": []})
        apart = distances(matrix(vectors), pivots)
        cell = apart.argmin(axis=1)
        return pd.DataFrame({"cell": cell, "shell": np.floor(apart[np.arange(len(cell)), cell] / width).astype(int)})

    return place("vector")


def stored(df: DataFrame, pivots: np.ndarray, width: float) -> DataFrame:
    """``df`` with the cell and shell of each row's vector."""
    return df.withColumn("_p", _place(pivots, width)).select(*df.columns, F.col("_p.cell").alias("_cell"), F.col("_p.shell").alias("_shell"))


def build(df: DataFrame, eps: float, n_pivots: int | None = None) -> Shells:
    """The index for joins of ``df(id, vector)`` within ``eps``; a cell is cut into ``MAX_SHELLS`` at most."""
    n = df.count()
    pivots = choose(df, n_pivots or min(MAX_PIVOTS, max(2, n // CELL_ROWS))) if n else np.zeros((1, 1))

    @F.pandas_udf("double")
    def apart(vectors: pd.Series) -> pd.Series:
        return pd.Series([], dtype=float) if len(vectors) == 0 else pd.Series(distances(matrix(vectors), pivots).min(axis=1))

    furthest = df.select(apart("vector").alias("a")).agg(F.max("a")).first()[0] or 0.0
    width = max(eps if eps > 0 else 1.0, furthest / MAX_SHELLS)
    last = np.full(len(pivots), -1)
    for r in stored(df, pivots, width).groupBy("_cell").agg(F.max("_shell").alias("s")).collect():  # a row per pivot
        last[r["_cell"]] = r.s
    return Shells(pivots, distances(pivots, pivots), width, last)


def _list(index: Shells, cell, shell):
    """The number of a cell's shell among the shells of all cells."""
    return cell * (int(index.last.max()) + 1) + shell


def _reach(index: Shells, eps: float):
    """A UDF: the shells of all cells that can hold a row within ``eps``, as bits in the order of ``_list``."""
    pivots, between, width, last = index.pivots, index.between, index.width, index.last
    planes = min(PLANES, len(pivots))
    shells = np.arange(max(int(last.max()), 0) + 1)

    def reach(vectors: np.ndarray) -> np.ndarray:
        apart = distances(vectors, pivots)
        slack = ROUNDING * (1 + apart.max(axis=1, keepdims=True))
        beyond = np.zeros_like(apart)  # distance to the furthest plane that parts the row from a cell
        squares, longest = apart ** 2, 1e-3 * apart.max()
        for q in np.argpartition(apart, planes - 1, axis=1)[:, :planes].T:
            gap = between[q]
            own = squares[np.arange(len(q)), q][:, None]
            far = gap > longest  # close pivots would blow rounding up
            beyond = np.maximum(beyond, np.divide(squares - own, 2 * gap, out=np.zeros_like(apart), where=far))
        low = np.maximum(np.floor((apart - eps - slack) / width), 0).astype(int)
        high = np.minimum(np.floor((apart + eps + slack) / width).astype(int), last[None, :])
        high = np.where(beyond > eps + slack, -1, high)
        met = (low[:, :, None] <= shells) & (shells <= high[:, :, None])
        return met.reshape(len(met), -1)

    @F.pandas_udf("binary")
    def bits(vectors: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype=object)
        parts = [vectors.iloc[at:at + REACH_ROWS] for at in range(0, len(vectors), REACH_ROWS)]
        return pd.concat([in_groups(reach(matrix(part))) for part in parts], ignore_index=True)

    return bits("vector")


def looking(df: DataFrame, index: Shells, eps: float) -> DataFrame:
    """``df`` with the cells and shells that can hold a row within ``eps`` of each row, for ``listed_join``."""
    return df.withColumn("_all", _reach(index, eps)).withColumn("_visits", visits(F.col("_all"), index.lists)).drop("_all")


def listed(df: DataFrame, index: Shells) -> DataFrame:
    """``df`` with the number of the shell that holds each row."""
    placed = stored(df, index.pivots, index.width)
    return placed.withColumn("_list", _list(index, F.col("_cell"), F.col("_shell")).cast("int")).drop("_cell", "_shell")


def near_join(left: DataFrame, right: DataFrame, index: Shells, eps: float, ids: tuple[str, str], fn, schema: str, fold=None) -> DataFrame:
    """``fn`` over tiles of rows that can lie within ``eps`` of each other; every such pair is in exactly one.

    A looking row is shuffled once per group of shells, not once per shell.
    """
    return listed_join(looking(left, index, eps), listed(right, index), [], ids, fn, schema, fold)


def near_blocks(left: DataFrame, right: DataFrame, index: Shells, eps: float, ids: tuple[str, str], fn, schema: str) -> DataFrame:
    """``fn(l, r, near, tiles, schema)`` for blocks of rows that can lie within ``eps`` of each other; every such pair is in one tile.

    ``l`` and ``r`` are Arrow tables, ``near`` tells which pairs are, and ``tiles`` are ``nearest.Segments``.
    """
    def block(_, l: pa.Table, r: pa.Table, kind: pa.Schema) -> pa.Table:
        lists = r["_list"].to_numpy()
        order = np.argsort(lists, kind="stable")
        r = r.take(pa.array(order))
        ends = np.flatnonzero(np.diff(lists[order], append=-1)) + 1
        met = met_lists(b"".join(l["_bits"].to_pylist()), len(l), lists[order][ends - 1])
        return fn(l, r, Near(vectors(l["vector"]), vectors(r["vector"]), eps), Segments(len(l), len(r), met, ends), kind)

    return listed_blocks(looking(left, index, eps), listed(right, index), [], ids, block, schema)


def pairs_met(left: DataFrame, right: DataFrame, index: Shells, eps: float) -> int:
    """Pairs whose distance ``near_join`` computes."""
    sizes = np.zeros(index.lists, dtype=np.int64)
    for r in listed(right, index).groupBy("_list").agg(F.count("*").alias("n")).collect():  # a row per shell
        sizes[r["_list"]] = r.n

    @F.pandas_udf("long")
    def met(groups: pd.Series, bits: pd.Series) -> pd.Series:
        lists = [np.arange(g, len(sizes), GROUPS) for g in range(GROUPS)]
        return pd.Series([int(sizes[lists[g]][met_lists(b, 1, lists[g])[0]].sum()) for g, b in zip(groups, bits)], dtype="int64")

    seen = looking(left, index, eps).select(F.explode("_visits").alias("v"))
    return seen.agg(F.sum(met("v._group", "v._bits"))).first()[0] or 0
