"""Clusterings, their scores and the choice between them."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.util import inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions import vector as V
from wayfare.operators.blocks import block_join, distances, equal_rows, matrix, ranks, stars, unit_rows
from wayfare.operators.features import mean_vector
from wayfare.operators.nearest import NONE, Near, Segments
from wayfare.operators.shells import Shells, near_blocks
from wayfare.operators.shells import build as build_shells
from wayfare.session import cut_lineage

# Fixed values of the clustering step.
SEED = 42
MAX_CLUSTERS = 50
MAX_ITER = 300
STARTS = 10
EPS = 0.5
MIN_POINTS = 5
RELATED_ABOVE = 0.3
NOISE = -1

PARALLEL_FITS = 4
# Values that may be ranked in one task; more are fenced further first.
RANKED_VALUES = 100_000


def candidate_counts(n: int) -> list[int]:
    """Cluster counts to try for ``n`` rows: about five steps between n/100 and min(n/10, 50)."""
    high = max(2, min(n // 10, MAX_CLUSTERS))
    low = min(max(2, n // 100), high)
    return list(range(low, high + 1, max(1, (high - low) // 5)))


# -- fitting --------------------------------------------------------------------

def _grid(df: DataFrame, make, counts: Sequence[int], seeds: Sequence[int]) -> tuple[DataFrame | None, list[dict]]:
    """Best fit by silhouette over the grid, with the score of every fit; a few fits run side by side.

    ``df`` has arrays or ML vectors; sparse ones stay sparse. Only the vectors are kept in memory.
    """
    prepared = df.withColumn("_f", F.col("vector") if isinstance(df.schema["vector"].dataType, VectorUDT) else array_to_vector("vector"))
    data = prepared.select("_f").persist()
    evaluator = ClusteringEvaluator(featuresCol="_f", predictionCol="label", metricName="silhouette")

    def fit(point):
        k, seed = point
        model = make(k, seed).setFeaturesCol("_f").setPredictionCol("label").fit(data)
        if sum(size > 0 for size in model.summary.clusterSizes) < 2:
            return None
        return evaluator.evaluate(model.transform(data)), model, {"k": k, "seed": seed}

    try:
        with ThreadPool(PARALLEL_FITS) as pool:
            fits = [f for f in pool.map(inheritable_thread_target(data.sparkSession)(fit), [(k, s) for k in counts for s in seeds]) if f]
        if not fits:
            return None, []
        _, model, _ = max(fits, key=lambda f: f[0])
        labelled = model.transform(prepared).drop("_f")
        return labelled, [{**point, "silhouette": score} for score, _, point in fits]
    finally:
        data.unpersist()


def kmeans_grid(df: DataFrame, counts: Sequence[int], starts: int = STARTS, max_iter: int = MAX_ITER):
    def make(k, seed):
        return KMeans(k=k, seed=seed, maxIter=max_iter)

    return _grid(df, make, counts, [SEED + i for i in range(starts)])


def bisecting_grid(df: DataFrame, counts: Sequence[int], max_iter: int = 20):
    """Divisive hierarchy in place of agglomeration, which has no distributed form."""
    def make(k, seed):
        return BisectingKMeans(k=k, seed=seed, maxIter=max_iter)

    return _grid(df, make, counts, [SEED])


def exact_median(df: DataFrame, column: str, error: float = 1e-3, few: int = RANKED_VALUES) -> float:
    """Median without bringing the column together.

    Approximate quantiles fence the middle again and again until few rows are
    left inside; only the distinct values there, with their counts, are ranked.
    """
    values = df.select(F.col(column).alias("x")).filter(F.col("x").isNotNull())
    n = values.count()
    inside, below, size = values, 0, n
    while size > few:
        share = ((n + 1) // 2 - below) / size
        low, high = inside.approxQuantile("x", [max(0.0, share - 2 * error), min(1.0, share + 2 * error)], error)
        fenced = values.filter(F.col("x").between(low, high))
        kept, below = values.agg(F.count_if(F.col("x").between(low, high)), F.count_if(F.col("x") < low)).first()
        stuck, inside, size = kept >= size, fenced, kept
        if stuck:
            break
    ranked = inside.groupBy("x").agg(F.count("*").alias("c")).withColumn(
        "upto", F.sum("c").over(Window.orderBy("x")) + F.lit(below))
    wanted = ranked.agg(
        F.min(F.when(F.col("upto") >= (n + 1) // 2, F.col("x"))).alias("a"),
        F.min(F.when(F.col("upto") >= n // 2 + 1, F.col("x"))).alias("b")).first()
    return (wanted.a + wanted.b) / 2


def median_split(df: DataFrame) -> DataFrame:
    """Two groups: above and not above the median of the first principal component."""
    prepared = df.withColumn("_f", array_to_vector("vector"))
    projected = PCA(k=1, inputCol="_f", outputCol="_p").fit(prepared).transform(prepared).withColumn(
        "component", F.get(vector_to_array("_p"), F.lit(0))).drop("_f", "_p")
    middle = exact_median(projected, "component")
    return projected.withColumn("label", (F.col("component") > middle).cast("int"))


# -- density clustering -----------------------------------------------------------

def id_type(df: DataFrame) -> str:
    """Type of the id column, for schemas of results that carry it."""
    return dict(df.dtypes)["id"]


def neighbour_counts(df: DataFrame, eps: float, index: Shells | None = None) -> DataFrame:
    """Rows within eps of each row, itself included."""
    def count(l: pa.Table, r: pa.Table, near: Near, tiles: Segments, kind: pa.Schema) -> pa.Table:
        n = np.zeros(len(l), np.int64)
        for _, _, columns in tiles:
            for rows, cols in columns:
                n[rows] += near.counts(rows, cols)
        a, b = equal_rows(l["id"], r["other"])
        np.add.at(n, a, tiles.holds(a, b) & ~near.settled(a, b))  # a row counts itself, however rounding has it
        return pa.table({"id": l["id"], "n": n}).cast(kind)

    points = df.select("id", "vector")
    other = points.withColumnRenamed("id", "other")
    parts = near_blocks(points, other, index or build_shells(points, eps), eps, ("id", "other"), count, f"id {id_type(df)}, n long")
    return parts.groupBy("id").agg(F.sum("n").alias("n_neighbours"))


def linked(n: int, m: int, near: Near, tiles: Segments) -> np.ndarray:
    """A number per row of two blocks (``n``, then ``m``), the same for rows that near pairs link.

    Rows of the largest component found so far need not meet each other, so
    where most are linked soon only the few others are compared.
    """
    label = np.arange(n + m)

    def link(a: np.ndarray, b: np.ndarray) -> None:
        apart = label[a] != label[n + b]
        if apart.any():
            parts = np.unique(np.stack([label[a[apart]], label[n + b[apart]]], axis=1), axis=0)
            member, smallest = stars(parts[:, 0], parts[:, 1])
            to = np.arange(n + m)
            to[member] = smallest
            label[:] = to[label]

    for _, _, columns in tiles:
        most = np.bincount(label).argmax()
        for rows, cols in columns:
            at = np.arange(rows.start, rows.stop) if isinstance(rows, slice) else rows
            to = np.arange(cols.start, cols.stop)
            inside, within = label[at] == most, label[n + to] == most
            if not inside.any() or not within.any():
                link(*near.pairs(rows, cols))
                most = np.bincount(label).argmax() if not inside.any() else most
                continue
            if not inside.all():
                link(*near.pairs(at[~inside], to))
            if not within.all():
                link(*near.pairs(at[inside], to[~within]))
            most = label[at[inside][0]]
    return label


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: (id, component = smallest id), by alternating star steps.

    Each round is written out, so a lost executor costs one round at most. It
    ends when every row has one parent and a whole round has changed nothing.
    """
    def directed(e, keep):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        return both.filter(keep)

    def star(e, large: bool):
        around = directed(e, F.lit(True)) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        joined = around.join(lowest, "a")
        if large:
            out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
                lowest.select("a", F.col("low").alias("b")))
        return out.filter(F.col("a") != F.col("b")).distinct()

    def fingerprint(e):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")).first())

    current = cut_lineage(edges.filter(F.col("a") != F.col("b")).distinct())
    seen = None
    while True:
        current = cut_lineage(star(star(current, large=True), large=False))
        now = fingerprint(current)
        if now == seen and now[0] == now[2]:
            break
        seen = now
    leaves = current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)


def dbscan(df: DataFrame, eps: float = EPS, min_points: int = MIN_POINTS) -> DataFrame:
    """Density clustering of ``df(id, vector)``: label = smallest core id of the cluster, -1 for noise.

    A block gives back a forest with the components of its links, not the
    links, so dense regions do not blow up, and rows that are linked already
    are not compared; the forests joined have the same components.
    """
    points = df.select("id", "vector")
    index = build_shells(points, eps)
    counted = cut_lineage(points.join(neighbour_counts(points, eps, index), "id"))
    core = counted.filter(F.col("n_neighbours") >= min_points).select("id", "vector")
    others = core.select(F.col("id").alias("other"), "vector")

    def links(l: pa.Table, r: pa.Table, near: Near, tiles: Segments, kind: pa.Schema) -> pa.Table:
        label = linked(len(l), len(r), near, tiles)
        ids = pa.concat_arrays([c for side in (l["id"], r["other"]) for c in side.chunks])
        # Each member of a component with the smallest id in it.
        smallest = np.full(len(label), NONE)
        by_id = ranks(pa.chunked_array([ids]))
        np.minimum.at(smallest, label, by_id)
        at = np.empty(len(ids), np.int64)
        at[by_id] = np.arange(len(ids))
        first = at[smallest[label]]
        members = np.flatnonzero(first != np.arange(len(ids)))
        return pa.table({"a": ids.take(pa.array(members)), "b": ids.take(pa.array(first[members]))}).cast(kind)

    edges = near_blocks(core, others, index, eps, ("id", "other"), links, f"a {id_type(df)}, b {id_type(df)}")
    grouped = components(edges)
    labelled = core.select("id").join(grouped, "id", "left").select("id", F.coalesce("component", "id").alias("label"))

    def border(l: pa.Table, r: pa.Table, near: Near, tiles: Segments, kind: pa.Schema) -> pa.Table:
        by_label = ranks(r["label"])
        lowest = np.full(len(l), NONE)
        for _, _, columns in tiles:
            for rows, cols in columns:
                a, b = near.pairs(rows, cols)  # few: a row of the border has fewer near rows than make a core
                np.minimum.at(lowest, a, by_label[b])
        found = np.flatnonzero(lowest != NONE)
        at = np.argsort(by_label, kind="stable")[lowest[found]]
        return pa.table({"id": l["id"].take(pa.array(found)), "label": r["label"].take(pa.array(at))}).cast(kind)

    rest = counted.filter(F.col("n_neighbours") < min_points).select("id", "vector")
    core_labels = others.join(labelled.withColumnRenamed("id", "other"), "other")
    edge_points = near_blocks(rest, core_labels, index, eps, ("id", "other"), border, f"id {id_type(df)}, label {id_type(df)}")
    edge_points = edge_points.groupBy("id").agg(F.min("label").alias("label"))
    known = labelled.unionByName(edge_points)
    return counted.select("id", "n_neighbours").join(known, "id", "left").select(
        "id", "n_neighbours", F.coalesce("label", F.lit(NOISE).cast(id_type(df))).alias("label"))


# -- scores (per method; df has id, method, label, vector) ---------------------------
#
# One rule for rows with the noise label: like every other label they count as a cluster in all scores. Callers who
# want them left out filter them first. A method with one cluster has silhouette 0 and no other score.

def with_groupings(df: DataFrame, groupings: dict[str, str]) -> DataFrame:
    """Several clusterings of the same rows in long form: method -> label expression, from one scan."""
    pairs = F.array(*[F.struct(F.lit(m).alias("method"), F.expr(e).cast("long").alias("label")) for m, e in groupings.items()])
    rest = [c for c in df.columns if c not in ("method", "label")]
    return df.withColumn("_g", F.explode(pairs)).select("_g.method", "_g.label", *rest)


def centroids(df: DataFrame) -> DataFrame:
    """Mean vector per cluster proper; noise is none."""
    return cluster_means(df.filter(F.col("label") >= 0))


def cluster_means(df: DataFrame) -> DataFrame:
    """Mean vector per label."""
    return mean_vector(df, ["method", "label"], "vector", "centroid")


def calinski_harabasz(df: DataFrame) -> DataFrame:
    """Between over within dispersion, from sums per cluster: one pass over the rows."""
    per_cluster = df.groupBy("method", "label").agg(
        F.count("*").alias("n"), F.sum(V.dot(F.col("vector"), F.col("vector"))).alias("squares"),
        Summarizer.mean(array_to_vector("vector")).alias("c"))
    sized = per_cluster.withColumn("centre", vector_to_array("c"))
    overall = sized.groupBy("method").agg(
        F.count("*").alias("k"), F.sum("n").alias("total"), F.sum("squares").alias("squares"),
        F.sum(F.col("n") * V.dot(F.col("centre"), F.col("centre"))).alias("centre_squares"),
        Summarizer.mean(F.col("c"), F.col("n").cast("double")).alias("g"))
    g = vector_to_array("g")
    within = F.col("squares") - F.col("centre_squares")
    between = F.col("centre_squares") - F.col("total") * V.dot(g, g)
    return overall.select("method", F.try_divide(
        between * (F.col("total") - F.col("k")), within * (F.col("k") - 1)).alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame) -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / centre distance; the small table of centres is computed once."""
    centre = cut_lineage(cluster_means(df))
    spread = (
        df.join(centre, ["method", "label"])
        .withColumn("_d", F.zip_with("vector", "centroid", lambda a, b: a - b))
        .groupBy("method", "label").agg(F.avg(V.norm(F.col("_d"))).alias("spread"))
    )
    clusters = centre.join(spread, ["method", "label"]).select("method", F.col("label").cast("long").alias("label"), "centroid", "spread")
    others = clusters.select("method", F.col("label").alias("other"), "centroid", "spread")

    def worst(key, l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        apart = distances(matrix(l["centroid"]), matrix(r["centroid"]))
        total = l["spread"].to_numpy()[:, None] + r["spread"].to_numpy()[None, :]
        same = l["label"].to_numpy()[:, None] == r["other"].to_numpy()[None, :]
        ratio = np.where(same | (apart == 0), 0.0, total / np.where(apart == 0, 1.0, apart))
        return pd.DataFrame({"method": key[0], "label": l["label"], "ratio": ratio.max(axis=1)})

    ratios = block_join(clusters, others, ["method"], ("label", "other"), worst, "method string, label long, ratio double")
    return ratios.groupBy("method", "label").agg(F.max("ratio").alias("ratio")).groupBy("method").agg(
        F.when(F.count("*") > 1, F.avg("ratio")).alias("davies_bouldin"))


def silhouette(df: DataFrame) -> DataFrame:
    """Mean silhouette with plain Euclidean distance, exact.

    Needs every distance, so the work grows with the square of the rows; only
    distance sums per row and cluster leave a task. For large data use
    ``silhouette_squared``, which is linear.
    """
    points = df.select("method", "id", F.col("label").cast("long").alias("label"), "vector")
    others = points.select("method", F.col("id").alias("other"), F.col("label").alias("other_label"), "vector")

    def sums(key, l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        apart = distances(matrix(l["vector"]), matrix(r["vector"]))
        apart[l["id"].to_numpy()[:, None] == r["other"].to_numpy()[None, :]] = 0.0
        labels, where = np.unique(r["other_label"].to_numpy(), return_inverse=True)
        member = np.eye(len(labels))[where]
        return pd.DataFrame({
            "method": key[0], "id": np.repeat(l["id"].to_numpy(), len(labels)),
            "label": np.repeat(l["label"].to_numpy(), len(labels)), "other_label": np.tile(labels, len(l)),
            "total": (apart @ member).ravel(), "n": np.tile(member.sum(axis=0).astype(np.int64), len(l)),
        })

    def summed_up(found: pd.DataFrame) -> pd.DataFrame:
        return found.groupby(["method", "id", "label", "other_label"], as_index=False, dropna=False)[["total", "n"]].sum()

    parts = block_join(points, others, ["method"], ("id", "other"), sums,
                       f"method string, id {id_type(df)}, label long, other_label long, total double, n long", fold=summed_up)
    summed = parts.groupBy("method", "id", "label", "other_label").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    own = F.col("other_label") == F.col("label")
    per_point = summed.groupBy("method", "id").agg(
        F.max(F.when(own, F.try_divide(F.col("total"), F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"))
    value = F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return per_point.groupBy("method").agg(F.avg(value).alias("silhouette"))


def silhouette_squared(df: DataFrame) -> DataFrame:
    """Mean silhouette with squared Euclidean distance: linear in the rows.

    The mean squared distance of x to a cluster is |x|^2 - 2 x.mean + mean(|y|^2),
    so rows meet the cluster table, not each other.
    """
    squares = V.dot(F.col("vector"), F.col("vector"))
    clusters = df.groupBy("method", "label").agg(
        F.count("*").alias("n"), F.avg(squares).alias("mean_squares"), Summarizer.mean(array_to_vector("vector")).alias("c"))
    clusters = clusters.select("method", F.col("label").cast("long").alias("other"), "n", "mean_squares", vector_to_array("c").alias("centroid"))
    points = df.select("method", "id", F.col("label").cast("long").alias("label"), "vector")

    def parts(key, l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        x = matrix(l["vector"])
        mean = (x * x).sum(1)[:, None] - 2.0 * (x @ matrix(r["centroid"]).T) + r["mean_squares"].to_numpy()[None, :]
        n = r["n"].to_numpy(dtype=float)[None, :]
        own = l["label"].to_numpy()[:, None] == r["other"].to_numpy()[None, :]
        inside = np.where(own & (n > 1), mean * n / np.where(n > 1, n - 1, 1.0), np.nan)
        outside = np.where(own, np.inf, mean).min(axis=1)
        has_own = np.isfinite(inside).any(axis=1)
        a = np.where(has_own, np.nanmax(np.where(np.isnan(inside), -np.inf, inside), axis=1), np.nan)
        return pd.DataFrame({"method": key[0], "id": l["id"], "a": a, "b": outside})

    split = block_join(points, clusters, ["method"], ("id", "other"), parts, f"method string, id {id_type(df)}, a double, b double")
    per_point = split.groupBy("method", "id").agg(F.max(F.nanvl("a", F.lit(None).cast("double"))).alias("a"), F.min("b").alias("b"))
    value = F.when(F.col("a").isNull() | (F.col("b") == float("inf")), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return per_point.groupBy("method").agg(F.avg(value).alias("silhouette_squared"))


def scores(df: DataFrame) -> DataFrame:
    return silhouette_squared(df).join(calinski_harabasz(df), "method").join(davies_bouldin(df), "method")


def best_method(metrics: DataFrame, score: str) -> DataFrame:
    """Every method's scores with a mark on the best one; the smaller name wins a tie."""
    best = metrics.agg(F.min_by("method", F.struct(-F.col(score), F.col("method")))).scalar()
    return metrics.withColumn("is_best", F.col("method") == best)


def related(df: DataFrame, above: float = RELATED_ABOVE) -> DataFrame:
    """Pairs of clusters of one method whose centroids have cosine similarity above the cut."""
    centre = cut_lineage(centroids(df).select("method", F.col("label").cast("long").alias("label"), "centroid"))
    others = centre.select("method", F.col("label").alias("other"), "centroid")

    def similar(key, l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        cosine = unit_rows(matrix(l["centroid"])) @ unit_rows(matrix(r["centroid"])).T
        a, b = np.nonzero((cosine > above) & (l["label"].to_numpy()[:, None] < r["other"].to_numpy()[None, :]))
        return pd.DataFrame({"method": key[0], "label": l["label"].to_numpy()[a], "other": r["other"].to_numpy()[b], "similarity": cosine[a, b]})

    return block_join(centre, others, ["method"], ("label", "other"), similar, "method string, label long, other long, similarity double")


def cluster_rows(df: DataFrame, starts: int = STARTS) -> dict[str, tuple[DataFrame, list[dict]]]:
    """The cascade: both grids, density clustering if neither worked, a median split as the last resort."""
    counts = candidate_counts(df.count())
    results = {}
    for name, fit in (("kmeans", lambda: kmeans_grid(df, counts, starts)), ("hierarchical", lambda: bisecting_grid(df, counts))):
        labelled, tried = fit()
        if labelled is not None:
            results[name] = (labelled, tried)
    if not results:
        dense = dbscan(df)
        if dense.filter(F.col("label") >= 0).select("label").distinct().limit(2).count() == 2:
            results["dbscan"] = (df.join(dense.select("id", "label"), "id"), [])
    if not results:
        results["binary"] = (median_split(df), [])
    return results
