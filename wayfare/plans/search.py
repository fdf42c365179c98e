"""Vector search, combined candidates and day plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfare.functions import vector as V
from wayfare.operators import cluster as C
from wayfare.operators import inverted, recommend, search
from wayfare.operators.reviews import cap_per_group
from wayfare.registry import query
from wayfare.session import cut_lineage


def corpus(t):
    """The review vectors, language standing for the city and source for the category."""
    return t.review_vector.select(F.col("vec_id").alias("id"), "vector", "lang", "source")


def asked(t):
    """Every vector asks for rows like it."""
    return corpus(t).select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"), "lang", "source")


def _top(filters: str, where: str = "true", extra: str = "") -> str:
    on = " AND ".join(f"q.{f} = c.{f}" for f in filters.split())
    return f"""
        SELECT q.vec_id AS query_id, c.vec_id AS id, round(list_cosine_similarity(q.vector, c.vector), 6) AS score{extra}
        FROM review_vector q JOIN review_vector c ON {on} WHERE {where}
        QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY score DESC, c.vec_id) <= 5"""


@query("vector_topk", f"""
    SELECT query_id, id, score, source FROM ({_top('lang', extra=', c.source')})""", ("review_vector",))
def vector_topk(t):
    found = search.top_k(asked(t), corpus(t), ["lang"])
    return search.with_metadata(found, corpus(t), ["source"]).select("query_id", "id", "score", "metadata.source")


@query("vector_topk_filtered", _top("lang source"), ("review_vector",))
def vector_topk_filtered(t):
    return search.top_k(asked(t), corpus(t), ["lang", "source"]).drop("match_rank")


def approximate(t, filters):
    """Search through inverted lists of codes, with as many lists as measured to be needed."""
    rows = cut_lineage(corpus(t).select("id", "vector", *filters))
    index = inverted.build(rows, filters)
    return inverted.search(index, asked(t).select("query_id", "query_vector", *filters), rows, probes=inverted.calibrate(index, rows))


@query("vector_topk_approx")
def vector_topk_approx(t):
    return approximate(t, ["lang"]).drop("match_rank")


@query("vector_approx_recall", f"""
    SELECT count(DISTINCT query_id) AS n_queries, count(*) AS n_true, true AS recall_reached FROM ({_top('lang')})""", ("review_vector",))
def vector_approx_recall(t):
    """Share of the exact results that the approximate search finds, against its aim of 0.95."""
    exact = search.top_k(asked(t), corpus(t), ["lang"])
    counted = inverted.recall(approximate(t, ["lang"]), exact)
    return counted.select("n_queries", "n_true", (F.col("n_found") >= 0.95 * F.col("n_true")).alias("recall_reached"))


@query("vector_topk_cells", """
    SELECT q.vec_id AS query_id, c.vec_id AS id, round(list_cosine_similarity(q.vector, c.vector), 6) AS score
    FROM review_vector q, review_vector c
    QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY score DESC, c.vec_id) <= 5""", ("review_vector",))
def vector_topk_cells(t):
    """Search without a filter through coarse cells, about the square root of the corpus of them."""
    rows = corpus(t)
    centres = search.fit_cells(rows, search.cell_count(rows.count()))
    stored = cut_lineage(search.with_cell(rows, centres))
    return search.top_k_by_cells(asked(t), stored, centres).drop("match_rank")


@query("vector_fallback", """
    WITH corpus AS (SELECT vec_id AS id, vector, lang, source FROM review_vector),
         asked AS (SELECT vec_id AS query_id, vector, lang, CASE WHEN label < 3 THEN 'src99' ELSE source END AS source FROM review_vector),
         first AS (SELECT query_id, id, round(list_cosine_similarity(a.vector, c.vector), 6) AS score
                   FROM asked a JOIN corpus c ON a.lang = c.lang AND a.source = c.source
                   QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 5),
         city AS (SELECT lang, list(m ORDER BY i) AS vector FROM
                     (SELECT lang, i, avg(x) AS m FROM (SELECT lang, unnest(vector) AS x, unnest(range(len(vector))) AS i FROM corpus)
                      GROUP BY lang, i) GROUP BY lang),
         again AS (SELECT query_id, id, round(list_cosine_similarity(v.vector, c.vector), 6) AS score
                   FROM (SELECT * FROM asked WHERE query_id NOT IN (SELECT query_id FROM first)) a
                   JOIN city v ON a.lang = v.lang JOIN corpus c ON a.lang = c.lang
                   QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 5)
    SELECT query_id, id, score, false AS used_fallback FROM first UNION ALL SELECT query_id, id, score, true FROM again""", ("review_vector",))
def vector_fallback(t):
    """Queries of three labels ask for a source that does not exist and fall back to their city."""
    wanted = t.review_vector.select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("query_vector"), "lang",
        F.when(F.col("label") < 3, "src99").otherwise(F.col("source")).alias("source"))
    return search.top_k_with_fallback(wanted, corpus(t), "lang", ["source"]).drop("match_rank")


@query("cosine_pairs", """
    SELECT vec_id, c.label, round(list_cosine_similarity(v.vector, c.centroid), 6) AS similarity,
           round(list_cosine_similarity(v.vector, list_transform(v.vector, lambda x: x * 2)), 6) AS with_double, 0.0::DOUBLE AS with_zero
    FROM clustered v JOIN centroid c ON v.method = c.method AND v.label = c.label""", ("centroid",))
def cosine_pairs(t):
    rows = t.review_vector.join(t.place_stats.select("place_id"), "place_id", "left_semi").select(
        "vec_id", F.lit("given").alias("method"), "label", "vector")
    joined = rows.join(C.centroids(rows), ["method", "label"])
    vector = F.col("vector")
    return joined.select(
        "vec_id", "label", F.round(V.cosine(vector, F.col("centroid")), 6).alias("similarity"),
        F.round(V.cosine(vector, F.transform(vector, lambda x: x * 2)), 6).alias("with_double"),
        V.cosine(vector, F.transform(vector, lambda x: x * 0)).alias("with_zero"))


@query("candidates_union", """
    WITH ranked AS (SELECT city, place_id, round(mean_rating, 6) AS score FROM place JOIN place_stats USING (place_id) WHERE type <> 'VACATION_RENTAL'
                    QUALIFY row_number() OVER (PARTITION BY city ORDER BY mean_rating DESC, place_id) <= 5),
         graph AS (SELECT DISTINCT v.vec_id AS request_id, r.place_id, r.score, 'graph' AS source
                   FROM clustered v JOIN ranked r ON v.city = r.city),
         near AS (SELECT q.vec_id AS request_id, c.place_id, round(list_cosine_similarity(q.vector, c.vector), 6) AS score, 'vector' AS source
                  FROM clustered q JOIN clustered c ON q.city = c.city
                  QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY score DESC, c.vec_id) <= 5)
    SELECT request_id, place_id, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, max(score) AS best_score
    FROM (SELECT * FROM graph UNION ALL SELECT * FROM near) GROUP BY request_id, place_id""", ("clustered",))
def candidates_union(t):
    """Best rated places of the city and places of similar reviews, per request."""
    rows = t.clustered.select("vec_id", "vector", "city", "place_id")
    places = t.place.filter(F.col("type") != "VACATION_RENTAL").join(t.place_stats.select("place_id", "mean_rating"), "place_id")
    best = cap_per_group(places, ["city"], [F.col("mean_rating").desc(), F.col("place_id")], 5)
    best = best.select("city", "place_id", F.round("mean_rating", 6).alias("score"))
    graph = rows.select(F.col("vec_id").alias("request_id"), "city").join(best, "city").select("request_id", "place_id", "score")
    stored = rows.select(F.col("vec_id").alias("id"), "vector", "city")
    wanted = rows.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query_vector"), "city")
    found = search.top_k(wanted, stored, ["city"]).join(rows.select(F.col("vec_id").alias("id"), "place_id"), "id")
    near = found.select(F.col("query_id").alias("request_id"), "place_id", "score")
    return recommend.union_candidates(graph, near, ["request_id", "place_id"], "score")


_PLAN = """
    WITH ranked AS (SELECT city, type, p.place_id, name, price, row_number() OVER (PARTITION BY city, type ORDER BY mean_rating DESC, p.place_id) AS r
                    FROM place p JOIN place_stats s ON p.place_id = s.place_id WHERE type <> 'VACATION_RENTAL'),
         available AS (SELECT city, type, max(r) AS m FROM ranked GROUP BY city, type),
         trip AS (SELECT o_orderkey AS request_id, n_name AS city, 2 + o_orderkey % 9 AS n_days
                  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
         slots AS (SELECT request_id, city, type, 0 AS day, slot FROM trip, (VALUES ('HOTEL')) AS v(type), (VALUES (1), (2)) AS s(slot)
                   UNION ALL SELECT request_id, city, type, d, d FROM trip, (VALUES ('ATTRACTION'), ('RESTAURANT')) AS v(type),
                             range(1, 11) AS s(d) WHERE d <= n_days),
         planned AS (SELECT request_id, s.city, CAST(s.day AS INTEGER) AS day, s.type, k.place_id, k.name, k.price
                     FROM slots s JOIN available a ON s.city = a.city AND s.type = a.type
                     JOIN ranked k ON k.city = s.city AND k.type = s.type AND k.r = (s.slot - 1) % a.m + 1
                     WHERE s.type <> 'HOTEL' OR s.slot <= a.m)"""


def _plan(t):
    places = t.place.filter(F.col("type") != "VACATION_RENTAL").join(
        t.place_stats.select("place_id", F.col("mean_rating").alias("rating")), "place_id")
    return recommend.day_plan(t.trip.select("request_id", "city", "n_days"), places)


@query("day_plan", _PLAN + " SELECT * FROM planned", ("place", "place_stats"))
def day_plan(t):
    return _plan(t)


@query("daily_spend", _PLAN + """
    SELECT request_id, day, round(sum(price), 2) AS spend, count(*) AS n_stops FROM planned WHERE day > 0 GROUP BY request_id, day""", ("place", "place_stats"))
def daily_spend(t):
    return recommend.daily_spend(_plan(t)).withColumn("spend", F.round("spend", 2))


@query("lists_roundtrip", """
    SELECT city, type, place_id, name, price, row_number() OVER (PARTITION BY city, type ORDER BY price DESC, place_id) AS place_rank
    FROM place QUALIFY place_rank <= 5""", ("place",))
def lists_roundtrip(t):
    """Five places per city and type as parallel lists, and back."""
    best = cap_per_group(t.place, ["city", "type"], [F.col("price").desc(), F.col("place_id")], 5, rank="place_rank")
    lists = recommend.to_lists(best, ["city", "type"], "place_rank", ["place_id", "name", "price"])
    return recommend.from_lists(lists, ["city", "type"], ["place_rank", "place_id", "name", "price"]).withColumn(
        "place_rank", F.col("place_rank").cast("long"))
