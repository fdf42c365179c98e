"""Comparing two sets of vectors block by block.

Some results need every row of one group met with every row of another:
nearest neighbours under a filter, distance sums, links above a threshold.
Joining the rows would put all pairs into a shuffle. Here both groups are cut
into blocks of bounded size, a pair of blocks is one task's work, done in tiles
of matrix products, and only the reduced result (k best, sums, a forest) leaves
the task. A group that holds a third of all rows just has more blocks.

A row is shuffled once per block of the other side, so blocks are as many as
keep some tasks busy and no more, until their bytes ask for more: what is
shuffled grows with the rows, not with their square.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows of a tile on each side; a block of fewer rows is not cut for the sake of more tasks.
BLOCK_ROWS = 2048
#: Most bytes of a block, as its columns count in memory.
BLOCK_BYTES = 48 << 20
#: Pairs of blocks aimed at where the rows allow it.
PAIRS = 64
#: Results of a pair of blocks are folded when they come to so many rows, and again when those kept have doubled.
FOLD_ROWS = 1_000_000
#: Lists are dealt to so many groups; a row is shuffled once per group that it visits a list of.
GROUPS = 8
_RIGHT = "_right_"


def block_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ids: tuple[str, str],
               fn: Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str,
               rows: int | None = None, fold: Callable[[pd.DataFrame], pd.DataFrame] | None = None, pairs: int = PAIRS) -> DataFrame:
    """``fn(key values, left tile, right tile)`` for every pair of tiles of rows with equal ``keys``.

    ``fold`` shrinks the results of a pair of blocks put together, before they
    leave the task. ``rows``: cut to blocks of so many rows, whatever their bytes.
    """
    def by_tiles(key, l: pd.DataFrame, r: pd.DataFrame) -> Iterable[pd.DataFrame]:
        return (fn(key, a, b) for a in _tiles(l) for b in _tiles(r))

    return _joined(left, right, keys, ids, by_tiles, schema, rows, fold, pairs)


def whole_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ids: tuple[str, str],
               fn: Callable[[tuple, pa.Table, pa.Table, pa.Schema], pa.Table], schema: str,
               rows: int | None = None, pairs: int = PAIRS // 2, by_bytes: bool = False) -> DataFrame:
    """``fn(key values, left block, right block, schema of the result)`` once for every pair of blocks, as Arrow tables.

    ``by_bytes``: the right side is cut for its bytes alone, where each of its blocks gives results for every row of the left.
    """
    return _joined(left, right, keys, ids, fn, schema, rows, None, pairs, arrow=True, by_bytes=by_bytes)


def listed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ids: tuple[str, str],
                fn: Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str,
                fold: Callable[[pd.DataFrame], pd.DataFrame] | None = None) -> DataFrame:
    """``fn((*key values, list), left tile, right tile)`` for the rows of each list and the rows that visit it.

    A left row's ``_visits`` is made by ``in_groups``; a right row's list is ``_list``.
    """
    def by_lists(key, l: pd.DataFrame, r: pd.DataFrame) -> Iterable[pd.DataFrame]:
        lists, at = np.unique(r["_list"].to_numpy(), return_inverse=True)
        order = np.argsort(at, kind="stable")
        ends = np.searchsorted(at[order], np.arange(len(lists) + 1))
        r = r.drop(columns="_list")
        for tile in _tiles(l):
            met = met_lists(b"".join(tile["_bits"]), len(tile), lists)
            tile = tile.drop(columns="_bits")
            for i in np.flatnonzero(met.any(axis=0)):
                asking = tile[met[:, i]]
                for held in _tiles(r.iloc[order[ends[i]:ends[i + 1]]]):
                    yield fn((*key[:-1], lists[i]), asking, held)

    return _joined(left, right, keys, ids, by_lists, schema, None, fold, PAIRS, listed=True)


def listed_blocks(left: DataFrame, right: DataFrame, keys: Sequence[str], ids: tuple[str, str],
                  fn: Callable[[tuple, pa.Table, pa.Table, pa.Schema], pa.Table], schema: str) -> DataFrame:
    """``fn`` as for ``whole_join``, for the rows of a group of lists and the rows that visit some of them.

    The left block's ``_bits`` and the right block's ``_list`` say which (``Segments``).
    """
    return _joined(left, right, keys, ids, fn, schema, None, None, PAIRS, arrow=True, listed=True)


VISITS = "array<struct<_group:int,_bits:binary>>"


def in_groups(met: np.ndarray) -> pd.Series:
    """The lists that each row visits (rows x lists, true or false) as bits: list i is bit i // GROUPS of group i % GROUPS."""
    full = np.zeros((len(met), GROUPS, 8 * _width(met.shape[1])), bool)
    for group in range(GROUPS):
        part = met[:, group::GROUPS]
        full[:, group, :part.shape[1]] = part
    return pd.Series([row.tobytes() for row in np.packbits(full, axis=2)], dtype=object)


def _width(lists: int) -> int:
    """Bytes per group."""
    return -(-lists // (8 * GROUPS))


def visits(bits: Column, lists: int) -> Column:
    """What ``in_groups`` made as a value of type ``VISITS``: the groups in which a row visits a list."""
    width = _width(lists)
    parts = F.transform(F.sequence(F.lit(0), F.lit(GROUPS - 1)), lambda g: F.struct(
        g.alias("_group"), F.substr(bits, g * width + 1, F.lit(width)).alias("_bits")))
    return F.filter(parts, lambda part: part["_bits"] != F.lit(bytes(width)))


def met_lists(bits: bytes, n: int, lists: np.ndarray) -> np.ndarray:
    """Which of ``lists``, all of one group, each of ``n`` rows visits (rows x lists)."""
    return np.unpackbits(np.frombuffer(bits, np.uint8).reshape(n, -1), axis=1)[:, lists // GROUPS].astype(bool)


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], ids: tuple[str, str], one, schema: str,
            rows: int | None, fold, pairs: int, arrow: bool = False, by_bytes: bool = False, listed: bool = False) -> DataFrame:
    keys = list(keys)
    n_keys = len(keys)
    given = left.columns
    if listed:
        # The sizes are known before a row is copied: the groups of lists are the blocks of the right side, cut further for their bytes.
        right = right.withColumn("_group", F.pmod("_list", F.lit(GROUPS)).cast("int"))
        rights = right.groupBy(*keys, "_group").agg(F.ceil(_size(right)["bytes"] / F.lit(BLOCK_BYTES)).cast("long").alias("_nr"))
        entries = F.map_from_entries(F.collect_list(F.struct("_group", "_nr"))).alias("_nrs")
        if keys:
            sizes = left.groupBy(*keys).agg(_size(left).alias("_l")).join(rights.groupBy(*keys).agg(entries), keys)
            left, right = left.join(sizes, keys), right.join(rights, [*keys, "_group"])
            right = right.join(sizes.select(*keys, "_l"), keys)
        else:
            l, nrs = left.agg(_size(left)).scalar(), rights.agg(entries).scalar()
            left, right = left.select("*", l.alias("_l"), nrs.alias("_nrs")), right.select("*", l.alias("_l"), nrs.alias("_nrs"))
            right = right.withColumn("_nr", F.col("_nrs")[F.col("_group")]).drop("_nrs")
        by_pairs = F.least(F.ceil(F.col("_l.n") / F.lit(BLOCK_ROWS)), F.lit(max(1, pairs // GROUPS)))
        nl = F.greatest(F.ceil(F.col("_l.bytes") / F.lit(BLOCK_BYTES)), by_pairs).cast("long")
        left = left.withColumn("_nl", nl).withColumn("_v", F.explode("_visits")).select(
            *[c for c in given if c != "_visits"], "_v.*", "_nl", F.col("_nrs")[F.col("_v._group")].alias("_nr")).where("_nr IS NOT NULL")
        right = right.withColumn("_nl", nl).drop("_l")
        keys = [*keys, "_group"]
    elif keys:
        sizes = left.groupBy(*keys).agg(_size(left).alias("_l")).join(right.groupBy(*keys).agg(_size(right).alias("_r")), keys)
        sizes = sizes.select(*keys, *_blocks(F.col("_l"), F.col("_r"), rows, pairs, by_bytes))
        left, right = left.join(sizes, keys), right.join(sizes, keys)
    else:
        l, r = (df.agg(_size(df)).scalar() for df in (left, right))
        left, right = (df.select("*", l.alias("_l"), r.alias("_r")).select(*df.columns, *_blocks(F.col("_l"), F.col("_r"), rows, pairs, by_bytes))
                       for df in (left, right))
    number = F.lit(0).cast("long")
    placed_left = (
        left.withColumn("_lb", F.pmod(F.xxhash64(ids[0]), "_nl"))
        .withColumn("_rb", F.explode(F.sequence(number, F.greatest(F.col("_nr") - 1, number)))).drop("_nl", "_nr")
    )
    placed_right = (
        right.withColumn("_rb", F.pmod(F.xxhash64(ids[1]), "_nr"))
        .withColumn("_lb", F.explode(F.sequence(number, F.greatest(F.col("_nl") - 1, number)))).drop("_nl", "_nr")
    )
    # Own names on the right keep a set compared with itself apart from itself.
    placed_right = placed_right.select(*[F.col(c).alias(_RIGHT + c) for c in placed_right.columns])

    def one_pair(key, l, r):
        if len(l) == 0 or len(r) == 0:
            return pd.DataFrame(columns=_names)
        found, n, most = [], 0, FOLD_ROWS
        for f in one(tuple(key[:n_keys + listed]), l, r.rename(columns=lambda c: c.removeprefix(_RIGHT))):
            if len(f):
                found.append(f)
                n += len(f)
            if fold and n > most:
                found = [fold(pd.concat(found, ignore_index=True))]
                n = len(found[0])
                most = max(FOLD_ROWS, 2 * n)
        if not found:
            return pd.DataFrame(columns=_names)
        found = pd.concat(found, ignore_index=True) if len(found) > 1 else found[0]
        return fold(found) if fold else found

    def one_block(key, l, r):
        if len(l) == 0 or len(r) == 0:
            return kind.empty_table()
        return one(tuple(k.as_py() for k in key[:n_keys + listed]), l, r.rename_columns([c.removeprefix(_RIGHT) for c in r.column_names]), kind)

    _names = [part.split()[0] for part in schema.split(",")]
    by = [*keys, "_lb", "_rb"]
    both = placed_left.groupBy(*by).cogroup(placed_right.groupBy(*[_RIGHT + c for c in by]))
    if arrow:
        kind = to_arrow_schema(StructType.fromDDL(schema))
        return both.applyInArrow(one_block, schema)
    return both.applyInPandas(one_pair, schema)


def _tiles(df: pd.DataFrame) -> list[pd.DataFrame]:
    return [df.iloc[i:i + BLOCK_ROWS] for i in range(0, len(df), BLOCK_ROWS)]


def _size(df: DataFrame) -> Column:
    """Rows and bytes of ``df``, as (n, bytes)."""
    lists = [F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) * 8 for c, kind in df.dtypes if kind.startswith("array<")]
    each = sum(lists, F.lit(16 * len(df.columns)))
    return F.struct(F.count("*").alias("n"), F.coalesce(F.sum(each.cast("long")), F.lit(0)).alias("bytes"))


def _blocks(l: Column, r: Column, rows: int | None, pairs: int, by_bytes: bool = False) -> tuple[Column, Column]:
    """Numbers of blocks: by ``rows``, or by bytes and so that there are about ``pairs`` pairs of them."""
    def least(side):
        return F.ceil(side["n"] / F.lit(rows or BLOCK_ROWS)).cast("long")

    if rows:
        return least(l).alias("_nl"), least(r).alias("_nr")
    root = F.lit(round(pairs ** 0.5)).cast("long")

    def number(side, other):
        for_tasks = F.least(least(side), F.ceil(F.lit(pairs) / F.greatest(F.least(least(other), root), F.lit(1))))
        return F.greatest(F.ceil(side["bytes"] / F.lit(BLOCK_BYTES)), for_tasks).cast("long")

    if by_bytes:
        parts = F.greatest(F.ceil(r["bytes"] / F.lit(BLOCK_BYTES)), F.lit(1)).cast("long")
        for_tasks = F.least(least(l), F.ceil(F.lit(pairs) / parts))
        return F.greatest(F.ceil(l["bytes"] / F.lit(BLOCK_BYTES)), for_tasks).cast("long").alias("_nl"), parts.alias("_nr")
    return number(l, r).alias("_nl"), number(r, l).alias("_nr")


def vectors(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of an array column as a matrix, without a Python object per row."""
    lists = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    sizes = np.diff(lists.offsets.to_numpy())
    if lists.null_count or (sizes != sizes[:1]).any():
        raise ValueError("vectors must be there and of one length")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(lists), -1)


def ranks(column: pa.ChunkedArray) -> np.ndarray:
    """The place of each row in the order of its value, equal values in the order they come."""
    order = pc.sort_indices(column, null_placement="at_start").to_numpy()
    at = np.empty(len(order), np.int64)
    at[order] = np.arange(len(order))
    return at


def equal_rows(a: pa.ChunkedArray, b: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows of two columns with equal values; missing values equal none."""
    a = pa.table({"v": a, "a": pa.array(np.arange(len(a)))})
    b = pa.table({"v": b.cast(a["v"].type), "b": pa.array(np.arange(len(b)))})
    both = a.join(b, "v", join_type="inner")
    return both["a"].to_numpy(), both["b"].to_numpy()


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; a zero row stays zero and so scores 0 everywhere."""
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of two matrices."""
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0.0))


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (each member, smallest member) of the components that the links ``(a, b)`` make: fewer links than members."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[u], label[v])
        if (label[u] == low).all() and (label[v] == low).all():
            break
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        while (label[label] != label).any():
            label = label[label]
    linked = np.flatnonzero(label != np.arange(len(ids)))
    return ids[linked], ids[label[linked]]


def spanning_edges(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the two-sided graph ``near`` (rows x columns): at most rows + columns - 1 edges.

    Grows each component breadth first with whole-matrix steps, so a dense
    block costs one pass over the matrix and never lists its pairs.
    """
    row_left = np.ones(near.shape[0], bool)
    col_left = np.ones(near.shape[1], bool)
    rows_out, cols_out = [], []
    while row_left.any():
        frontier = np.array([np.argmax(row_left)])
        row_left[frontier] = False
        while frontier.size:
            open_cols = np.flatnonzero(col_left)
            hit = near[np.ix_(frontier, open_cols)]
            reached = hit.any(axis=0)
            cols = open_cols[reached]
            rows_out.append(frontier[hit[:, reached].argmax(axis=0)])
            cols_out.append(cols)
            col_left[cols] = False
            open_rows = np.flatnonzero(row_left)
            back = near[np.ix_(open_rows, cols)]
            found = back.any(axis=1) if cols.size else np.zeros(open_rows.size, bool)
            frontier = open_rows[found]
            if frontier.size:
                rows_out.append(frontier)
                cols_out.append(cols[back[found].argmax(axis=1)])
                row_left[frontier] = False
    if not rows_out:
        return np.array([], int), np.array([], int)
    return np.concatenate(rows_out), np.concatenate(cols_out)
