"""Ward's agglomeration by rounds of reciprocal nearest neighbours over cluster features.

A cluster is its size and mean; joining two adds n * m / (n + m) times the
squared distance of their means to the sum of squares. Clusters that are each
other's nearest can be joined at once, all such pairs in one round, and the
result is that of joining the closest pair of all again and again, because a
joined cluster is never nearer to a third than the nearer of its parts was. For
the same reason only clusters that were joined, or whose nearest was, look for
their nearest anew. Distances are computed block by block; the rounds end in one
task, which holds the clusters and not their distances, when few are left.

The first round compares all clusters, so rows in large numbers are first put
into many small cells (``micro_features``), whose features are then joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wayfare.operators.blocks import ranks, vectors, whole_join
from wayfare.operators.cluster import SEED, components, silhouette_squared
from wayfare.operators.features import mean_vector
from wayfare.operators.nearest import NONE, Segments, best_rows, product, products
from wayfare.session import cut_lineage

#: As many pairs of clusters as so many have are compared in one task; more are compared over all tasks.
FINISH_ROWS = 32_768
#: Most bytes of the clusters that one task joins; more are joined by rounds over all tasks first.
TASK_BYTES = 512 << 20
#: Others that a cluster keeps, and clusters whose costs to them are found at a time.
KNOWN, TILE_ROWS = 16, 4096
_MERGES = "id long, gone long, increase double, n long, round int"
_LEFT = "centre array<double>, near array<long>, bound double"
_STATE = [part.split()[0] for part in f"{_MERGES}, {_LEFT}".split(", ")]


def row_features(df: DataFrame) -> DataFrame:
    """Each row of ``df(id, vector)`` as a cluster of its own; ids are whole numbers."""
    return df.select(F.col("id").cast("long").alias("id"), F.lit(1).cast("long").alias("n"), F.col("vector").cast("array<double>").alias("centre"))


def micro_features(df: DataFrame, n_cells: int, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(features, rows with their cell in ``start``): rows dealt to ``n_cells`` k-means cells, each a cluster to start from."""
    prepared = df.withColumn("_f", array_to_vector("vector"))
    model = KMeans(k=n_cells, seed=seed, maxIter=10, featuresCol="_f", predictionCol="start").fit(prepared)
    rows = cut_lineage(model.transform(prepared).drop("_f"))
    means = mean_vector(rows, ["start"], "vector", "centre").join(rows.groupBy("start").agg(F.count("*").alias("n")), "start")
    return means.select(F.col("start").cast("long").alias("id"), "n", "centre"), rows


def increases(n: np.ndarray, x: np.ndarray, m: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What joining each cluster of one side with each of the other adds to the sum of squares."""
    apart = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.maximum(apart, 0.0) * (n[:, None] * m[None, :] / (n[:, None] + m[None, :]))


class Costs:
    """What joining a cluster with another adds, for ``best_rows``: the score is the cost with its sign turned."""

    def __init__(self, n: np.ndarray, x: np.ndarray, m: np.ndarray, y: np.ndarray):
        self.n, self.x, self.m, self.y = n, x, m, y
        self.own, self.others = ((m * m).sum(1) for m in (x, y))
        middle = y.mean(axis=0)
        a, b = x - middle, y - middle
        self.squares = (a * a).sum(1)
        longest = self.squares.max(initial=0.0), (b * b).sum(1).max(initial=0.0)
        self.slack = (a.shape[1] + 12) * 2.0 ** -23 * (2 * np.sqrt(np.prod(longest)) + longest[1]) + 2.0 ** -20 * longest[0]
        # |x|^2 less the squared distance, the length of y as one more dimension
        self.left = np.concatenate([2 * a, np.full((len(a), 1), -1.0)], axis=1).astype(np.float32)
        self.right = np.concatenate([b, (b * b).sum(1)[:, None]], axis=1).astype(np.float32)

    def rough(self, rows, cols):
        return product(self.left[rows], self.right[cols])

    def least(self, floor: np.ndarray, rows, cols) -> np.ndarray:
        n, m = self.n[rows], self.m[cols].min()
        return self.squares[rows] + floor * (1 + 2.0 ** -20) * (n + m) / (n * m) - self.slack

    def below(self, score: np.ndarray) -> np.ndarray:
        return score * (1 + 1e-9) - self.slack * 1e-6

    def dense(self, rows, cols) -> np.ndarray:
        return -increases(self.n[rows], self.x[rows], self.m[cols], self.y[cols])

    def pairs(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        apart = self.own[rows] + self.others[cols] - 2.0 * products(self.x, self.y, rows, cols)
        return -np.maximum(apart, 0.0) * (self.n[rows] * self.m[cols] / (self.n[rows] + self.m[cols]))


def _cost(n: np.ndarray, x: np.ndarray, m: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``increases`` of each cluster and the one (or those) beside it."""
    apart = x - y
    return np.einsum("...j,...j->...", apart, apart) * (n * m / (n + m))


def _closest(n: np.ndarray, x: np.ndarray, m: np.ndarray, y: np.ndarray, rank: np.ndarray, k: int):
    """The ``k`` clusters of least cost for each of one side, by ``rank``; equal costs go to the smaller."""
    order = np.lexsort((rank, m))  # sizes of a tile lie close to each other
    return best_rows(Costs(n, x, m[order], y[order]), Segments(len(n), len(m)), k, rank[order])


def _nearest(k: int):
    def nearest(_, l: pa.Table, r: pa.Table, kind: pa.Schema) -> pa.Table:
        ids = r["other"].to_numpy()
        by_id = np.argsort(ids, kind="stable")
        best = _closest(l["n"].to_numpy().astype(float), vectors(l["centre"]), r["n"].to_numpy().astype(float), vectors(r["centre"]), ranks(r["other"]), k + 1)
        rows, entry = np.nonzero(best.at != NONE)
        found = pa.table({"id": l["id"].to_numpy()[rows], "nearest": ids[by_id[best.at[rows, entry]]], "increase": -best.score[rows, entry] + 0.0})
        return found.filter(pc.not_equal(found["id"], found["nearest"])).cast(kind)

    return nearest


def _asked(live: DataFrame, k: int) -> DataFrame:
    """(id, least): for the clusters that know no others, the ``k`` of least cost as (increase, nearest), in order."""
    open_ = live.where("near IS NULL").select("id", "n", "centre")
    others = live.select(F.col("id").alias("other"), "n", "centre")
    found = whole_join(open_, others, [], ("id", "other"), _nearest(k), "id long, nearest long, increase double", by_bytes=True)
    best = found.groupBy("id").agg(F.slice(F.sort_array(F.collect_list(F.struct("increase", "nearest"))), 1, k).alias("least"))
    return open_.join(best, "id", "left")


def _with_nearest(live: DataFrame) -> DataFrame:
    """``live`` with the nearest cluster of those that have none noted; equal distances go to the smaller id."""
    asked = _asked(live.withColumn("near", F.col("nearest")), 1).select(
        "id", "n", "centre", F.col("least")[0]["nearest"].alias("nearest"), F.col("least")[0]["increase"].alias("increase"))
    return cut_lineage(live.where("nearest IS NOT NULL").unionByName(asked))


def _pairs(live: DataFrame) -> DataFrame:
    """Clusters that are each other's nearest; of rounding in a circle, the closest pair alone."""
    a = live.select("id", F.col("nearest").alias("gone"), "increase", "n", "centre")
    b = live.select(F.col("id").alias("gone"), F.col("nearest").alias("id"), F.col("n").alias("m"), F.col("centre").alias("other"))
    pairs = cut_lineage(a.where("id < gone").join(b, ["id", "gone"]))
    if not pairs.isEmpty():
        return pairs
    first = live.orderBy("increase", "id").limit(1).select(
        F.least("id", "nearest").alias("id"), F.greatest("id", "nearest").alias("gone"), "increase")
    own, other = live.select("id", "n", "centre"), live.select(F.col("id").alias("gone"), F.col("n").alias("m"), F.col("centre").alias("other"))
    return cut_lineage(first.join(own, "id").join(other, "gone"))


def _joined(live: DataFrame, pairs: DataFrame) -> DataFrame:
    """The clusters after a round; those that have to look for their nearest again have none."""
    share = F.col("n") / (F.col("n") + F.col("m"))
    mean = F.zip_with("centre", "other", lambda x, y: x * F.col("_share") + y * (1 - F.col("_share")))
    made = pairs.withColumn("_share", share).withColumn("centre", mean).select(
        "id", (F.col("n") + F.col("m")).alias("n"), "centre", F.lit(None).cast("long").alias("nearest"), F.lit(None).cast("double").alias("increase"))
    touched = pairs.select(F.explode(F.array("id", "gone")).alias("id"))
    kept = live.join(touched, "id", "left_anti").join(touched.select(F.col("id").alias("nearest"), F.lit(True).alias("_t")), "nearest", "left")
    kept = kept.select("id", "n", "centre", *(F.when(F.col("_t").isNull(), F.col(c)).alias(c) for c in ("nearest", "increase")))
    return cut_lineage(kept.unionByName(made))


class Known:
    """Clusters and, for each, others that come first for joining; all that are not among them cost ``bound`` or more.

    What a joined cluster knows is what its parts knew. Its bound follows from theirs by the rule that gives a joined
    cluster's costs from those of its parts (Lance and Williams), at the size of the third for which it is least.
    """

    def __init__(self, ids: np.ndarray, n: np.ndarray, x: np.ndarray, others: np.ndarray, bound: np.ndarray, first_round: int):
        """``others``: places in ``ids`` (clusters x others, -1 for none); ``ids`` ascend."""
        self.ids, self.n, self.x, self.others, self.bound = ids, n, x, others, bound
        self.root, self.alive = np.arange(len(ids)), np.ones(len(ids), bool)
        self.nearest, self.cost = np.full(len(ids), -1), np.full(len(ids), np.inf)
        self.number, self.out = first_round, []
        self.look(np.arange(len(ids)))

    def _costs(self, at: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The clusters that ``others`` have become, and the costs; none for what is not there or has become the same."""
        now = np.where(others < 0, -1, self.root[others])
        now[now == at[:, None]] = -1
        cost = np.empty(now.shape)
        for i in range(0, len(at), TILE_ROWS):
            a, b = at[i:i + TILE_ROWS, None], now[i:i + TILE_ROWS]
            cost[i:i + TILE_ROWS] = _cost(self.n[a], self.x[a], self.n[b], self.x[b])
        cost[now < 0] = np.inf
        return now, cost

    def look(self, at: np.ndarray) -> None:
        """The nearest of those known; equal costs go to the smaller id."""
        if not len(at):
            return
        now, cost = self._costs(at, self.others[at])
        self.cost[at] = least = cost.min(axis=1)
        self.nearest[at] = np.where(cost == least[:, None], now, len(self.ids)).min(axis=1)

    def sure(self) -> np.ndarray:
        """Clusters whose nearest is known to be the nearest of all."""
        return self.alive & (self.cost <= self.bound) & np.isfinite(self.cost)

    def tell(self, at: np.ndarray, others: np.ndarray, bound: np.ndarray) -> None:
        self.others[at], self.bound[at] = others, bound
        self.look(at)

    def join(self) -> bool:
        """One round: all pairs that are each other's nearest; of rounding in a circle, the closest pair alone. False if too little is known."""
        sure = self.sure()
        at = np.flatnonzero(sure)
        partner = self.nearest[at]
        low = at[sure[partner] & (self.nearest[partner] == at) & (at < partner)]
        if not len(low):
            if not len(at) or len(at) < self.alive.sum():
                return False
            a = at[self.cost[at].argmin()]
            b = self.nearest[a]
            low, high = np.array([min(a, b)]), np.array([max(a, b)])
            increase = self.cost[[a]]
        else:
            high, increase = self.nearest[low], self.cost[low]
        n, m = self.n[low], self.n[high]
        self.out.append((self.ids[low], self.ids[high], increase, n + m, np.full(len(low), self.number)))
        one, two = self.bound[low], self.bound[high]
        small, large = ((n + 1) * one + (m + 1) * two - increase) / (n + m + 1), one + two - increase
        bound = np.minimum(small, large) * (1 - 1e-12)
        self.x[low] = (self.x[low] * n[:, None] + self.x[high] * m[:, None]) / (n + m)[:, None]
        self.n[low] += m
        self.alive[high] = False
        self.root[high] = low
        self.root = self.root[self.root]
        # The nearest of both parts' others, each once; what does not fit lowers the bound.
        now, cost = self._costs(low, np.concatenate([self.others[low], self.others[high]], axis=1))
        order = np.argsort(now, axis=1, kind="stable")
        now, cost = np.take_along_axis(now, order, axis=1), np.take_along_axis(cost, order, axis=1)
        twice = np.zeros(now.shape, bool)
        twice[:, 1:] = now[:, 1:] == now[:, :-1]
        cost[twice], now[twice] = np.inf, -1
        order = np.argsort(cost, axis=1, kind="stable")
        now, cost = np.take_along_axis(now, order, axis=1), np.take_along_axis(cost, order, axis=1)
        k = self.others.shape[1]
        self.others[low], self.bound[low] = now[:, :k], np.minimum(bound, cost[:, k])
        self.nearest[low], self.cost[low] = now[:, 0], cost[:, 0]
        joined = np.zeros(len(self.ids), bool)
        joined[low] = joined[high] = True
        changed = self.alive & ~joined
        changed[changed] = joined[self.nearest[changed]]
        self.look(np.flatnonzero(changed))
        self.number += 1
        return True

    def ask(self, k: int) -> None:
        """Those that know too little are compared with all."""
        at, live = np.flatnonzero(self.alive & ~self.sure()), np.flatnonzero(self.alive)
        best = _closest(self.n[at], self.x[at], self.n[live], self.x[live], live, k + 2)  # of these one is the cluster itself, one the bound
        order = np.argsort(best.at == at[:, None], axis=1, kind="stable")
        others, cost = np.take_along_axis(best.at, order, axis=1), -np.take_along_axis(best.score, order, axis=1)
        self.tell(at, np.where(others[:, :k] == NONE, -1, others[:, :k]), cost[:, k])


def _join_known(first_round: int, finish_rows: int, k: int):
    """Joins of the clusters in one task as far as it is known which are the nearest; few are compared anew, until one is left."""
    def join(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        ids = rows["id"].to_numpy()
        near = rows["near"].combine_chunks()
        others = np.full((len(ids), k), -1)
        sizes = np.diff(near.offsets.to_numpy())
        at = np.searchsorted(ids, near.flatten().to_numpy())
        others[np.arange(k) < sizes[:, None]] = at
        known = Known(ids, rows["n"].to_numpy().astype(float), vectors(rows["centre"]).copy(), others, rows["bound"].to_numpy().copy(), first_round)
        while known.alive.sum() > 1:
            if not known.join():
                live = int(known.alive.sum())
                if live * (live - int(known.sure().sum())) > finish_rows ** 2:
                    break
                known.ask(k)
        low, high, increase, n, number = map(np.concatenate, zip(*known.out))
        joins = pa.table({"id": low, "gone": high, "increase": increase, "n": n.astype(np.int64), "round": number.astype(np.int32)})
        live = np.flatnonzero(known.alive)
        if len(live) == 1:
            live = live[:0]
        others = np.where(known.others[live] < 0, -1, known.root[known.others[live]])
        others[others == live[:, None]] = -1
        sure = known.sure()[live]
        there = (others >= 0) & sure[:, None]
        ends = np.concatenate([[0], there.sum(axis=1).cumsum()])
        left = pa.table({
            "id": ids[live], "n": known.n[live].astype(np.int64),
            "centre": pa.ListArray.from_arrays(pa.array(np.arange(len(live) + 1) * known.x.shape[1], pa.int32()), pa.array(known.x[live].ravel())),
            "near": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids[others[there]]), mask=pa.array(~sure)),
            "bound": known.bound[live]})
        return pa.concat_tables([joins, left], promote_options="default").select(_STATE).cast(kind)

    kind = to_arrow_schema(StructType.fromDDL(f"{_MERGES}, {_LEFT}"))
    return join


def merges(features: DataFrame, finish_rows: int = FINISH_ROWS, known: int = KNOWN) -> DataFrame:
    """(id, gone, increase, n, round): every join of ``features(id, n, centre)`` down to one cluster.

    A cluster goes by the smallest id in it; ``gone`` joins ``id`` and makes a
    cluster of ``n`` rows, which adds ``increase`` to the sum of squares (the
    usual height is the root of twice that). A join's increase is never smaller
    than those of the joins that made its parts, but for rounding.
    """
    none = [F.lit(None).cast(kind).alias(c) for c, kind in (("nearest", "long"), ("increase", "double"))]
    live = cut_lineage(features.select("id", "n", "centre", *none))
    rounds: list[DataFrame] = []
    number = 0
    n, width = live.agg(F.count("*"), F.max(F.size("centre"))).first()
    while n * (width + 4 * known) * 8 > TASK_BYTES:
        live = _with_nearest(live)
        pairs = _pairs(live)
        rounds.append(pairs.select("id", "gone", "increase", (F.col("n") + F.col("m")).alias("n"), F.lit(number).alias("round")))
        live = _joined(live, pairs)
        n, number = live.count(), number + 1
    live = live.select("id", "n", "centre", F.lit(None).cast("array<long>").alias("near"), F.lit(None).cast("double").alias("bound"))
    while n > 1:
        if n > finish_rows:
            least = F.coalesce("least", F.array().cast("array<struct<increase:double,nearest:long>>"))
            asked = _asked(live, known + 1).withColumn("least", least).select(
                "id", "n", "centre", F.slice("least.nearest", 1, known).alias("near"),
                F.coalesce(F.get("least", F.lit(known))["increase"], F.lit(float("inf"))).alias("bound"))
            live = live.where("near IS NOT NULL").unionByName(asked)
        else:
            live = live.select("id", "n", "centre", F.coalesce("near", F.array().cast("array<long>")).alias("near"), F.coalesce("bound", F.lit(0.0)).alias("bound"))
        done = cut_lineage(live.groupBy(F.lit("all")).applyInArrow(_join_known(number, finish_rows, known), f"{_MERGES}, {_LEFT}"))
        rounds.append(done.where("gone IS NOT NULL").select("id", "gone", "increase", "n", "round"))
        live = done.where("gone IS NULL").select("id", "n", "centre", "near", F.when(F.col("near").isNotNull(), F.col("bound")).alias("bound"))
        n, last = done.agg(F.count_if(F.col("gone").isNull()), F.max("round")).first()
        number = last + 1
    if not rounds:
        return cut_lineage(features.sparkSession.createDataFrame([], _MERGES))
    return cut_lineage(reduce(DataFrame.unionByName, rounds))


def cut(tree: DataFrame, starts: DataFrame, counts: Sequence[int]) -> DataFrame:
    """(id, k, label): the clusters of each start ``id`` when ``k`` clusters are left, for every k of ``counts``.

    The last joins, as many as the largest count, come to the driver; all
    others are links whose components are the finest clusters asked for.
    """
    most = max(counts)
    last = tree.orderBy(F.col("increase").desc(), F.col("round").desc(), "id").limit(most - 1).collect()
    above = tree.sparkSession.createDataFrame([(r.id, r.gone) for r in last], "id long, gone long")
    links = tree.select("id", "gone").join(F.broadcast(above), ["id", "gone"], "left_anti")
    found = components(links.select(F.col("id").alias("a"), F.col("gone").alias("b"))).select("id", F.col("component").alias("fine"))
    fine = starts.select("id").join(found, "id", "left").select("id", F.coalesce("fine", "id").alias("fine"))
    names = {r.fine: r.fine for r in fine.select("fine").distinct().collect()}  # at most as many as the largest count
    tables, left = [], list(reversed(last))
    for k in sorted(counts, reverse=True):
        while len(left) > k - 1:
            join = left.pop(0)
            a, b = names[join.id], names[join.gone]
            names = {fine: min(a, b) if name in (a, b) else name for fine, name in names.items()}
        tables += [(fine, k, name) for fine, name in names.items()]
    return fine.join(F.broadcast(tree.sparkSession.createDataFrame(tables, "fine long, k int, label long")), "fine").select("id", "k", "label")


def ward_grid(df: DataFrame, counts: Sequence[int], micro: int | None = None) -> tuple[DataFrame, list[dict]]:
    """The clustering of ``df(id, vector)`` with the best silhouette over ``counts``, and the score of every count.

    ``micro``: start from so many k-means cells in place of the rows themselves.
    """
    features, rows = micro_features(df, micro) if micro else (row_features(df), df.withColumn("start", F.col("id").cast("long")))
    features = cut_lineage(features)
    labels = cut_lineage(cut(merges(features), features, counts).withColumnRenamed("id", "start"))
    labelled = rows.join(labels, "start").drop("start")
    scored = silhouette_squared(labelled.select(F.col("k").cast("string").alias("method"), "id", "label", "vector")).collect()
    tried = sorted(({"k": int(r.method), "silhouette": r.silhouette_squared} for r in scored), key=lambda t: t["k"])
    best = max(tried, key=lambda t: (t["silhouette"], -t["k"]))["k"]
    return labelled.where(F.col("k") == best).drop("k"), tried
