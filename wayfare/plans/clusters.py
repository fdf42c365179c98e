"""Features, clusterings and their scores."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from wayfare.operators import cluster as C
from wayfare.operators import features as X
from wayfare.operators import ward as W
from wayfare.registry import query
from wayfare.session import cut_lineage

DIM = 64
REDUCED = 16


def points(t, groupings=None):
    rows = t.table("embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"), "label")
    return C.with_groupings(rows, groupings or {"given": "label"})


_POINTS = """
    p AS (SELECT 'given' AS method, vec_id AS id, CAST(label AS BIGINT) AS label, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings)"""
_DIMS = _POINTS + """,
    d AS (SELECT method, label, id, unnest(vector) AS x, unnest(range(len(vector))) AS i FROM p),
    c AS (SELECT method, label, i, avg(x) AS m, count(*) AS n FROM d GROUP BY method, label, i)"""


@query("centroids", f"WITH {_DIMS} SELECT method, label, CAST(i AS INTEGER) AS position, round(m, 6) AS mean FROM c")
def centroids(t):
    return C.centroids(points(t)).select("method", "label", F.posexplode("centroid").alias("position", "mean")).withColumn(
        "mean", F.round("mean", 6))


@query("calinski_harabasz", f"""
    WITH {_DIMS}, g AS (SELECT method, i, avg(x) AS m, count(*) AS n FROM d GROUP BY method, i),
    w AS (SELECT d.method, sum((x - m) * (x - m)) AS within FROM d JOIN c ON d.method = c.method AND d.label = c.label AND d.i = c.i GROUP BY d.method),
    b AS (SELECT c.method, sum(c.n * (c.m - g.m) * (c.m - g.m)) AS between, count(DISTINCT c.label) AS k, max(g.n) AS n
          FROM c JOIN g ON c.method = g.method AND c.i = g.i GROUP BY c.method)
    SELECT b.method, round((between / (k - 1)) / (within / (n - k)), 6) AS calinski_harabasz FROM b JOIN w ON b.method = w.method""")
def calinski_harabasz(t):
    return C.calinski_harabasz(points(t)).withColumn("calinski_harabasz", F.round("calinski_harabasz", 6))


@query("davies_bouldin", f"""
    WITH {_DIMS}, e AS (SELECT d.method, d.label, d.id, sqrt(sum((x - m) * (x - m))) AS dist
                        FROM d JOIN c ON d.method = c.method AND d.label = c.label AND d.i = c.i GROUP BY d.method, d.label, d.id),
    s AS (SELECT method, label, avg(dist) AS s FROM e GROUP BY method, label),
    m AS (SELECT a.method, a.label AS la, b.label AS lb, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS apart
          FROM c a JOIN c b ON a.method = b.method AND a.i = b.i AND a.label <> b.label GROUP BY ALL),
    r AS (SELECT m.method, la, max((sa.s + sb.s) / apart) AS ratio FROM m JOIN s sa ON m.method = sa.method AND la = sa.label
          JOIN s sb ON m.method = sb.method AND lb = sb.label GROUP BY m.method, la)
    SELECT method, round(avg(ratio), 6) AS davies_bouldin FROM r GROUP BY method""")
def davies_bouldin(t):
    return C.davies_bouldin(points(t)).withColumn("davies_bouldin", F.round("davies_bouldin", 6))


def _silhouette(power: str, points: str = _POINTS) -> str:
    return f"""{points},
    pairs AS (SELECT a.method, a.id, a.label, b.label AS other, sum(list_distance(a.vector, b.vector){power}) AS total, count(*) AS n
              FROM p a JOIN p b ON a.method = b.method GROUP BY ALL),
    ab AS (SELECT method, id, max(CASE WHEN label = other AND n > 1 THEN total / (n - 1) END) AS a,
                  min(CASE WHEN label <> other THEN total / n END) AS b FROM pairs GROUP BY method, id),
    sil AS (SELECT method, avg(CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS value FROM ab GROUP BY method)"""


@query("silhouette_exact", f"WITH {_silhouette('')} SELECT method, round(value, 6) AS silhouette FROM sil")
def silhouette_exact(t):
    return C.silhouette(points(t)).withColumn("silhouette", F.round("silhouette", 6))


@query("silhouette_squared", f"WITH {_silhouette(' ** 2')} SELECT method, round(value, 6) AS silhouette_squared FROM sil")
def silhouette_squared(t):
    return C.silhouette_squared(points(t)).withColumn("silhouette_squared", F.round("silhouette_squared", 6))


_METHODS = """
    p AS (SELECT 'given' AS method, vec_id AS id, CAST(label AS BIGINT) AS label, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings
          UNION ALL SELECT 'halves', vec_id, CAST(label // 5 AS BIGINT), CAST(embedding AS DOUBLE[]) FROM embeddings
          UNION ALL SELECT 'signs', vec_id, CAST(CASE WHEN embedding[1] > 0 THEN 1 ELSE 0 END AS BIGINT), CAST(embedding AS DOUBLE[]) FROM embeddings)"""


@query("model_select", f"""
    WITH {_silhouette(' ** 2', _METHODS)}
    SELECT method, round(value, 6) AS silhouette_squared,
           method = (SELECT method FROM sil ORDER BY round(value, 6) DESC, method LIMIT 1) AS is_best FROM sil""")
def model_select(t):
    """Three groupings of the same vectors scored side by side; the best is marked."""
    groupings = points(t, {"given": "label", "halves": "label div 5", "signs": "int(vector[0] > 0)"})
    scored = C.silhouette_squared(groupings).withColumn("silhouette_squared", F.round("silhouette_squared", 6))
    return C.best_method(scored, "silhouette_squared")


DBSCAN_EPS, DBSCAN_POINTS = 1.15, 5
_NEAR = f"""
    near AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.id = b.id OR list_distance(a.vector, b.vector) <= {DBSCAN_EPS}),
    counted AS (SELECT a AS id, count(*) AS n FROM near GROUP BY a)"""


@query("dbscan_core", f"""
    WITH {_POINTS}, {_NEAR} SELECT id, n AS n_neighbours, n >= {DBSCAN_POINTS} AS is_core FROM counted""")
def dbscan_core(t):
    rows = points(t).select("id", "vector")
    counts = C.neighbour_counts(rows, DBSCAN_EPS)
    return counts.withColumn("is_core", F.col("n_neighbours") >= DBSCAN_POINTS)


@query("dbscan", f"""
    WITH RECURSIVE {_POINTS}, {_NEAR},
    core AS (SELECT id FROM counted WHERE n >= {DBSCAN_POINTS}),
    link AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
    reach(id, seen) AS (SELECT id, id FROM core UNION SELECT reach.id, link.b FROM reach JOIN link ON reach.seen = link.a),
    comp AS (SELECT id, min(seen) AS label FROM reach GROUP BY id),
    border AS (SELECT a AS id, min(label) AS label FROM near JOIN comp ON b = comp.id
               WHERE a NOT IN (SELECT id FROM core) GROUP BY a)
    SELECT c.id, c.n AS n_neighbours, CAST(coalesce(comp.label, border.label, -1) AS BIGINT) AS label
    FROM counted c LEFT JOIN comp ON c.id = comp.id LEFT JOIN border ON c.id = border.id""")
def dbscan(t):
    return C.dbscan(points(t), DBSCAN_EPS, DBSCAN_POINTS)


@query("onehot_long", """
    SELECT vec_id, concat('primary_category_', primary_category) AS feature FROM clustered
    UNION ALL SELECT vec_id, concat('city_', city) FROM clustered UNION ALL SELECT vec_id, concat('state_', state) FROM clustered
    UNION ALL SELECT vec_id, concat('country_', country) FROM clustered UNION ALL SELECT vec_id, concat('sentiment_', sentiment) FROM clustered
    UNION ALL SELECT vec_id, concat('rating_tier_', rating_tier) FROM clustered
    UNION ALL SELECT vec_id, concat('popularity_tier_', popularity_tier) FROM clustered""", ("clustered",))
def onehot_long(t):
    names = ["primary_category", "city", "state", "country", "sentiment", "rating_tier", "popularity_tier"]
    return X.one_hot_long(t.clustered, "vec_id", names)


@query("standardize", """
    SELECT place_id, round((price - avg(price) OVER ()) / stddev_pop(price) OVER (), 6) AS price,
           round((n - avg(n) OVER ()) / stddev_pop(n) OVER (), 6) AS n,
           round((weighted_rating - avg(weighted_rating) OVER ()) / stddev_pop(weighted_rating) OVER (), 6) AS weighted_rating, 0.0::DOUBLE AS constant
    FROM place JOIN place_stats USING (place_id)""", ("place", "place_stats"))
def standardize(t):
    rows = t.place.select("place_id", "price").join(t.place_stats.select("place_id", "n", "weighted_rating"), "place_id")
    names = ["price", "n", "weighted_rating", "constant"]
    scaled = X.standardized(rows.withColumn("constant", F.lit(7.0)), names)
    return scaled.select("place_id", *[F.round(c, 6).alias(c) for c in names])


@query("feature_block", """
    SELECT vec_id, w.category_width, w.location_width, w.sentiment_width, w.rating_width, 1.0::DOUBLE AS category_sum, 3.0::DOUBLE AS location_sum,
           1.0::DOUBLE AS sentiment_sum, round(rating + weighted_rating + 2, 6) AS rating_sum
    FROM clustered, (SELECT CAST(count(DISTINCT primary_category) AS INTEGER) AS category_width,
                            CAST(count(DISTINCT city) + count(DISTINCT state) + count(DISTINCT country) AS INTEGER) AS location_width,
                            CAST(count(DISTINCT sentiment) AS INTEGER) AS sentiment_width,
                            CAST(2 + count(DISTINCT rating_tier) + count(DISTINCT popularity_tier) AS INTEGER) AS rating_width FROM clustered) w""", ("clustered",))
def feature_block(t):
    """Widths of the one-hot and rating blocks of each row."""
    encoded = X.encode(t.clustered)
    blocks = ("category_block", "location_block", "sentiment_block", "rating_block")
    return encoded.select("vec_id", *[F.size(vector_to_array(b)).alias(b.replace("block", "width")) for b in blocks],
                          *[F.round(F.aggregate(vector_to_array(b), F.lit(0.0), lambda a, x: a + x), 6).alias(b.replace("block", "sum")) for b in blocks])


@query("reduce_pca")
def reduce_pca(t):
    reduced = X.reduce_vectors(points(t), "vector", DIM, REDUCED)
    return reduced.select("id", F.posexplode(vector_to_array("reduced")).alias("position", "value"))


def encoded(t):
    return X.encode(X.reduce_vectors(t.clustered, "vector", DIM, REDUCED))


@query("combine_features")
def combine_features(t):
    rows = X.combine(encoded(t))
    return rows.select("vec_id", F.size("features").alias("width"),
                       F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x * x), 6).alias("square_length"))


def combined_points(t):
    """Combined features as clustering input, written once and read for every fit of the grid; means are left in, so that they stay sparse."""
    return cut_lineage(X.combine_sparse(encoded(t)).select(F.col("vec_id").alias("id"), F.col("features").alias("vector")))


def _counts(rows):
    return C.candidate_counts(rows.count())


@query("kmeans_fit")
def kmeans_fit(t):
    rows = combined_points(t)
    labelled, _ = C.kmeans_grid(rows, _counts(rows))
    return labelled.groupBy("label").agg(F.count("*").alias("size"))


@query("bisecting_fit")
def bisecting_fit(t):
    rows = combined_points(t)
    labelled, _ = C.bisecting_grid(rows, _counts(rows))
    return labelled.groupBy("label").agg(F.count("*").alias("size"))


@query("ward_merges", """
    WITH d AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
         v AS (SELECT i, sum(x * x) - sum(x) * sum(x) / count(*) AS squares FROM d GROUP BY i)
    SELECT n - 1 AS n_merges, n AS largest, round((SELECT sum(squares) FROM v), 6) AS total_increase, true AS grows
    FROM (SELECT count(*) AS n FROM embeddings)""")
def ward_merges(t):
    """Joins of Ward's tree over all vectors; what they add comes to the sum of squares about the mean, and a part's join never adds
    more than that of the whole."""
    tree = W.merges(W.row_features(points(t).drop("label")))
    later = tree.select(F.col("id").alias("whole"), F.col("n").alias("size"), F.col("increase").alias("above"), F.col("round").alias("at"))
    # A cluster goes by its smallest id: the next join under the same id holds it as a part.
    steps = tree.join(later, (F.col("id") == F.col("whole")) & (F.col("at") > F.col("round")))
    shrinks = steps.where(F.col("above") < F.col("increase") * (1 - 1e-9)).agg(F.count("*").alias("bad"))
    return tree.agg(F.count("*").alias("n_merges"), F.max("n").alias("largest"), F.round(F.sum("increase"), 6).alias("total_increase")).withColumn(
        "grows", F.lit(0) == shrinks.scalar())


@query("median_split", """
    SELECT 0 AS label, n - n // 2 AS size FROM (SELECT count(*) AS n FROM embeddings)
    UNION ALL SELECT 1, n // 2 FROM (SELECT count(*) AS n FROM embeddings)""")
def median_split(t):
    return C.median_split(points(t).drop("label")).groupBy("label").agg(F.count("*").alias("size"))


@query("tfidf_vectors")
def tfidf_vectors(t):
    """Hashed TF-IDF of every document: entries kept and length of the vector."""
    rows = X.hashed_tfidf(t.table("documents").select("doc_id", "lang", "text"), "text").select("doc_id", "lang", "features")
    return rows.groupBy("lang").agg(F.count("*").alias("n_documents"), Summarizer.numNonZeros(F.col("features")).alias("v")).select(
        "lang", "n_documents", F.aggregate(vector_to_array("v"), F.lit(0.0), lambda a, x: a + x).alias("n_entries"))
