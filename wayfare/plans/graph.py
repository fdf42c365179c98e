"""Node and edge tables and pattern queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfare.functions import rules
from wayfare.operators import cluster as C
from wayfare.operators import graph as G
from wayfare.operators import reviews as R
from wayfare.plans import reviews  # noqa: F401 - registers the profile whose SQL the cluster nodes share
from wayfare.registry import ORACLES, query

_ATTRACTIONS = """
    SELECT place_id AS attraction_id, name, price AS rating, CAST(size_no AS INTEGER) AS review_count,
           CASE WHEN country = 'EAST' THEN size_no ELSE 0 END AS ranking, '' AS phone, '' AS website, '' AS email, brand AS description,
           CAST(CASE WHEN state = 'ASIA' THEN 1.5 ELSE 0 END AS DOUBLE) AS latitude, 0.0::DOUBLE AS longitude
    FROM place WHERE type = 'ATTRACTION'"""


@query("nodes_place", _ATTRACTIONS, ("place",))
def nodes_place(t):
    """Attraction nodes from a text table with two versions of every id; the newest wins."""
    text = t.place.filter(F.col("type") == "ATTRACTION").select(
        F.col("place_id").alias("attraction_id"), "name", F.col("price").cast("string").alias("rating"),
        F.concat(F.col("size_no").cast("string"), F.lit(".9")).alias("review_count"),
        F.when(F.col("country") == "EAST", F.col("size_no").cast("string")).otherwise("n/a").alias("ranking"),
        *[F.lit(None).cast("string").alias(c) for c in ("phone", "website", "email")], F.col("brand").alias("description"),
        F.when(F.col("state") == "ASIA", "1.5").alias("latitude"), F.lit("").alias("longitude"), F.lit(2).alias("version"))
    older = text.withColumn("version", F.lit(1)).withColumn("name", F.lit("old name"))
    return G.place_nodes(older.unionByName(text), "Attraction", ["version"])


@query("nodes_hotel", """
    SELECT place_id AS hotel_id, name, price AS rating, CAST(size_no AS INTEGER) AS review_count, brand AS price_range, 0 AS ranking, '' AS phone,
           concat(city, ', ', state) AS address, '' AS website, '' AS email, CASE WHEN country = 'EAST' THEN 3.5 ELSE 0 END::DOUBLE AS hotel_class,
           CAST(size_no * 2 AS INTEGER) AS number_of_rooms, 0.0::DOUBLE AS latitude, 1.5::DOUBLE AS longitude FROM place WHERE type = 'HOTEL'""", ("place",))
def nodes_hotel(t):
    text = t.place.filter(F.col("type") == "HOTEL").select(
        F.col("place_id").alias("hotel_id"), "name", F.col("price").cast("string").alias("rating"), F.col("size_no").cast("string").alias("review_count"),
        F.col("brand").alias("price_range"), *[F.lit(None).cast("string").alias(c) for c in ("ranking", "phone", "website", "email", "latitude")],
        F.concat_ws(", ", "city", "state").alias("address"), F.when(F.col("country") == "EAST", "3.5").alias("hotel_class"),
        (F.col("size_no") * 2).cast("string").alias("number_of_rooms"), F.lit("1.5").alias("longitude"), F.lit(1).alias("version"))
    return G.place_nodes(text.unionByName(text), "Hotel", ["version"])


@query("nodes_restaurant", """
    SELECT place_id AS restaurant_id, name, price AS rating, 0 AS review_count, CASE WHEN price > 1000 THEN '$$' ELSE '' END AS price_category,
           CAST(size_no AS INTEGER) AS ranking, '' AS phone, concat('http://r/', place_id) AS website, '' AS email, brand AS cuisines,
           2.25::DOUBLE AS latitude, 0.0::DOUBLE AS longitude FROM place WHERE type = 'RESTAURANT'""", ("place",))
def nodes_restaurant(t):
    text = t.place.filter(F.col("type") == "RESTAURANT").select(
        F.col("place_id").alias("restaurant_id"), "name", F.col("price").cast("string").alias("rating"), F.lit("many").alias("review_count"),
        F.when(F.col("price") > 1000, "$$").alias("price_category"), F.col("size_no").cast("string").alias("ranking"),
        *[F.lit(None).cast("string").alias(c) for c in ("phone", "email", "longitude")], F.concat(F.lit("http://r/"), "place_id").alias("website"),
        F.col("brand").alias("cuisines"), F.lit("2.25").alias("latitude"), F.lit(2).alias("version"))
    older = text.withColumns({"version": F.lit(1), "name": F.lit("old")})
    return G.place_nodes(older.unionByName(text), "Restaurant", ["version"])


def review_nodes(t):
    texts = t.review.select(
        "review_id", "rating", F.concat(F.lit("stay of "), F.col("trip_type")).alias("text"), F.when(F.col("line_no") > 2, F.col("status")).alias("title"),
        F.date_format("published", "yyyy-MM").alias("travel_date"), "trip_type", F.concat(F.lit("user"), F.col("user_id")).alias("user_name"), "user_id")
    return G.review_nodes(texts, ["travel_date", "user_id", "rating", "trip_type", "title"])


@query("nodes_review", """
    SELECT review_id, CAST(rating AS DOUBLE) AS rating, concat('stay of ', trip_type) AS text, CASE WHEN line_no > 2 THEN status ELSE '' END AS title,
           strftime(published, '%Y-%m') AS travel_date, trip_type, concat('user', user_id) AS user_name, user_id FROM review
    QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY strftime(published, '%Y-%m') DESC, user_id DESC, rating DESC, trip_type DESC,
                               CASE WHEN line_no > 2 THEN status END DESC NULLS LAST) = 1""", ("review",))
def nodes_review(t):
    """One node per review id: of several rows the one that is last by its own values."""
    return review_nodes(t)


@query("nodes_city", "SELECT DISTINCT concat_ws('|', city, state) AS id, city AS name, state FROM place WHERE type <> 'VACATION_RENTAL'", ("place",))
def nodes_city(t):
    return t.node.filter(F.col("label") == "City").select("id", "name", "state")


@query("edges_located_in", "SELECT src_label, src, rel, dst_label, dst FROM edge WHERE rel = 'LOCATED_IN'", ("edge",))
def edges_located_in(t):
    return t.edge.filter(F.col("rel") == "LOCATED_IN")


@query("edges_category", "SELECT src_label, src, rel, dst_label, dst FROM edge WHERE rel = 'HAS_CATEGORY'", ("edge",))
def edges_category(t):
    return t.edge.filter(F.col("rel") == "HAS_CATEGORY")


@query("edges_other", """
    SELECT DISTINCT 'Restaurant' AS src_label, place_id AS src, 'SERVES_CUISINE' AS rel, 'Cuisine' AS dst_label, brand AS dst FROM place WHERE type = 'RESTAURANT'
    UNION ALL SELECT DISTINCT 'Restaurant', place_id, 'ACCOMMODATES', 'DietaryRestriction', primary_category FROM place WHERE type = 'RESTAURANT'
    UNION ALL SELECT DISTINCT 'Hotel', place_id, 'IN_TIER_CLUSTER', 'TierCluster',
        CASE WHEN price - 800 < 100 THEN 'BUDGET' WHEN price - 800 < 200 THEN 'MIDRANGE' WHEN price - 800 < 300 THEN 'UPSCALE' ELSE 'LUXURY' END
        FROM place WHERE type = 'HOTEL'
    UNION ALL SELECT DISTINCT 'City', concat_ws('|', city, state), 'LOCATED_IN', 'State', state FROM place""", ("place",))
def edges_other(t):
    """Cuisine, diet, tier and state links."""
    restaurants = t.place.filter(F.col("type") == "RESTAURANT")
    hotels = t.place.filter(F.col("type") == "HOTEL")
    place_id = F.col("place_id")
    tier = rules.tier_below(F.col("price") - 800, rules.HOTEL_TIERS)
    return (
        G.edges_between(restaurants, F.lit("Restaurant"), place_id, "SERVES_CUISINE", F.lit("Cuisine"), F.col("brand"))
        .unionByName(G.edges_between(restaurants, F.lit("Restaurant"), place_id, "ACCOMMODATES", F.lit("DietaryRestriction"), F.col("primary_category")))
        .unionByName(G.edges_between(hotels, F.lit("Hotel"), place_id, "IN_TIER_CLUSTER", F.lit("TierCluster"), tier))
        .unionByName(G.edges_between(t.place, F.lit("City"), G.city_id(), "LOCATED_IN", F.lit("State"), F.col("state")))
    )


@query("edges_reviews", """
    SELECT DISTINCT 'Review' AS src_label, r.review_id AS src, 'REVIEWS' AS rel, 'Attraction' AS dst_label, r.place_id AS dst
    FROM review r JOIN place p ON r.place_id = p.place_id WHERE p.type = 'ATTRACTION'""", ("place", "review"))
def edges_reviews(t):
    attractions = t.place.filter(F.col("type") == "ATTRACTION").select("place_id")
    attached = t.review.select("review_id", "place_id").join(attractions, "place_id", "left_semi")
    return G.edges_between(attached, F.lit("Review"), F.col("review_id"), "REVIEWS", F.lit("Attraction"), F.col("place_id"))


@query("orphan_reviews", """
    SELECT review_id, place_id FROM review WHERE place_id NOT IN (SELECT place_id FROM place WHERE type = 'ATTRACTION')""", ("place", "review"))
def orphan_reviews(t):
    attractions = t.place.filter(F.col("type") == "ATTRACTION").select("place_id")
    return t.review.select("review_id", "place_id").join(attractions, "place_id", "left_anti")


@query("edges_in_cluster", """
    SELECT place_id AS src, concat_ws('_', method, label) AS dst, method, count(*) AS n_reviews FROM clustered
    WHERE label >= 0 GROUP BY place_id, method, label""", ("clustered",))
def edges_in_cluster(t):
    """One edge per place and cluster; the number of reviews behind it is its weight."""
    return R.without_noise(t.clustered).groupBy(
        F.col("place_id").alias("src"), F.concat_ws("_", "method", F.col("label").cast("string")).alias("dst"), "method").agg(
        F.count("*").alias("n_reviews"))


@query("nodes_cluster", f"""
    SELECT concat_ws('_', p.method, p.label) AS cluster_id, p.method, p.size, p.mean_rating AS avg_rating, p.weighted_avg, p.dominant_category,
           p.dominant_sentiment, p.dominant_tier, p.top_city, p.top_state, p.top_country, p.n_attraction AS n_attractions, p.n_city AS n_cities,
           c.n_categories, c.n_sentiments
    FROM ({ORACLES['cluster_profile']}) p JOIN (
        SELECT method, label, count(DISTINCT primary_category) AS n_categories, count(DISTINCT sentiment) AS n_sentiments FROM clustered
        GROUP BY method, label) c ON p.method = c.method AND p.label = c.label""", ("clustered",))
def nodes_cluster(t):
    """Cluster nodes with size, ratings, categories, sentiments, popularity, locations and attractions."""
    profile = R.cluster_profile(t.clustered)
    return profile.select(
        F.concat_ws("_", "method", F.col("label").cast("string")).alias("cluster_id"), "method", "size",
        F.round("mean_rating", 6).alias("avg_rating"), F.round("weighted_avg", 6).alias("weighted_avg"), "dominant_category", "dominant_sentiment",
        "dominant_tier", "top_city", "top_state", "top_country", F.col("n_attraction").alias("n_attractions"), F.col("n_city").alias("n_cities"),
        F.col("n_category").alias("n_categories"), F.col("n_sentiment").alias("n_sentiments"))


_CENTROID_PAIRS = """
    SELECT a.method, CAST(a.label AS BIGINT) AS label, CAST(b.label AS BIGINT) AS other,
           round(list_cosine_similarity(a.centroid, b.centroid), 6) AS similarity
    FROM centroid a JOIN centroid b ON a.method = b.method AND a.label < b.label"""


@query("related_clusters", f"SELECT * FROM ({_CENTROID_PAIRS}) WHERE similarity > 0.05", ("centroid",))
def related_clusters(t):
    """The centroids of the given clusters are nearly orthogonal, so the cut is lowered from 0.3 to show pairs."""
    placed = t.review_vector.join(t.place_stats.select("place_id"), "place_id", "left_semi")
    vectors = C.with_groupings(placed.select("label", "vector"), {"given": "label"})
    return C.related(vectors, above=0.05).withColumn("similarity", F.round("similarity", 6))


@query("related_above_cut", """
    WITH v AS (SELECT label, unnest(CAST(embedding AS DOUBLE[])) + CASE WHEN label % 3 = 0 THEN 0.3 ELSE 0 END AS x,
                      unnest(range(len(embedding))) AS i FROM embeddings),
         c AS (SELECT label, list(m ORDER BY i) AS centroid FROM (SELECT label, i, avg(x) AS m FROM v GROUP BY label, i) GROUP BY label),
         p AS (SELECT CAST(a.label AS BIGINT) AS label, CAST(b.label AS BIGINT) AS other, round(list_cosine_similarity(a.centroid, b.centroid), 6) AS similarity
               FROM c a JOIN c b ON a.label < b.label)
    SELECT 'given' AS method, * FROM p WHERE similarity > 0.3""")
def related_above_cut(t):
    """The strict cut of 0.3 on clusters of which every third is moved the same way."""
    moved = t.table("embeddings").select(
        "label", F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.when(F.col("label") % 3 == 0, 0.3).otherwise(0.0)).alias("vector"))
    return C.related(C.with_groupings(moved, {"given": "label"})).withColumn("similarity", F.round("similarity", 6))


@query("node_counts", "SELECT label, count(*) AS n FROM node GROUP BY label UNION ALL SELECT 'Review', count(DISTINCT review_id) FROM review", ("node", "review"))
def node_counts(t):
    return G.node_counts(t.node.unionByName(G.as_nodes(review_nodes(t))))


@query("graph_schema", "SELECT src_label, rel, dst_label, count(*) AS n FROM edge GROUP BY ALL", ("edge",))
def graph_schema(t):
    return G.schema_of(t.edge)


TRIPLETS = [
    {"subject": {"type": "Hotel", "properties": {}}, "relation": "LOCATED_IN", "object": {"type": "City", "properties": {"name": ["NATION_3"]}}},
    {"subject": {"type": "Attraction", "properties": {}}, "relation": "HAS_CATEGORY", "object": {"type": "Category", "properties": {"name": ["ECONOMY", "SMALL"]}}},
    {"subject": {"type": "Restaurant", "properties": {"primary_category": []}}, "relation": "LOCATED_IN", "object": {"type": "City", "properties": {"name": ["NOWHERE"]}}},
]


@query("triplet_query", """
    SELECT 'LOCATED_IN' AS relationship_type, n.name AS "Hotel_name", round(n.rating, 6) AS "Hotel_rating", n.price AS "Hotel_price", n.city AS "Hotel_city",
           m.name AS "City_name", m.state AS "City_state"
    FROM edge e JOIN node n ON e.src = n.id AND n.label = 'Hotel' JOIN node m ON e.dst = m.id AND m.label = 'City'
    WHERE e.rel = 'LOCATED_IN' AND e.src_label = 'Hotel' AND e.dst_label = 'City' AND m.name = 'NATION_3'
    ORDER BY n.rating DESC, n.id, m.id LIMIT 5""", ("node", "edge"))
def triplet_query(t):
    return G.match(t.node, t.edge, TRIPLETS[0], k=5).withColumn("Hotel_rating", F.round("Hotel_rating", 6))


@query("triplet_batch", """
    WITH one AS (SELECT 1 AS query_no, n.name FROM edge e JOIN node n ON e.src = n.id AND n.label = 'Hotel'
                 WHERE e.rel = 'LOCATED_IN' AND e.src_label = 'Hotel' AND e.dst LIKE 'NATION_3|%' ORDER BY n.rating DESC, n.id LIMIT 5),
         two AS (SELECT 2 AS query_no, n.name FROM edge e JOIN node n ON e.src = n.id AND n.label = 'Attraction'
                 WHERE e.rel = 'HAS_CATEGORY' AND e.dst IN ('ECONOMY', 'SMALL') ORDER BY n.rating DESC, n.id, e.dst LIMIT 5)
    SELECT query_no, name AS subject_name FROM one UNION ALL SELECT query_no, name FROM two""", ("node", "edge"))
def triplet_batch(t):
    """Three patterns; the third has no match and so adds nothing."""
    found = G.match_all(t.node, t.edge, TRIPLETS, k=5)
    return found.select("query_no", F.coalesce("Hotel_name", "Attraction_name", "Restaurant_name").alias("subject_name"))


@query("pattern_table", """
    WITH ranked AS (SELECT e.src_label, m.name AS city, n.id AS src, round(n.rating, 6) AS rating,
                           row_number() OVER (PARTITION BY e.src_label, m.name ORDER BY n.rating DESC, n.id, m.id) AS place_rank
                    FROM edge e JOIN node n ON e.src = n.id AND n.label = e.src_label JOIN node m ON e.dst = m.id AND m.label = 'City'
                    WHERE e.rel = 'LOCATED_IN')
    SELECT o_orderkey AS request_id, src_label, src, rating, CAST(place_rank AS INTEGER) AS place_rank
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN ranked ON ranked.city = n_name WHERE place_rank <= 3""", ("node", "edge"))
def pattern_table(t):
    """Hotels, attractions and restaurants of every request's city: equal patterns are answered once."""
    asked = t.trip.select(
        "request_id", F.col("city").alias("dst_name"),
        F.explode(F.array(*[F.lit(label) for label in G.PLACE_LABELS.values()])).alias("src_label"),
        F.lit("LOCATED_IN").alias("rel"), F.lit("City").alias("dst_label"))
    found = G.match_patterns(t.node, t.edge, asked, k=3)
    return asked.join(found, ["src_label", "rel", "dst_label", "dst_name"]).select(
        "request_id", "src_label", "src", F.round("rating", 6).alias("rating"), "place_rank")


@query("triplet_validate", """
    WITH asked AS (SELECT place_id AS src, CASE type WHEN 'HOTEL' THEN 'Hotel' WHEN 'ATTRACTION' THEN 'Attraction' ELSE 'Restaurant' END AS src_label,
                          CASE WHEN type = 'VACATION_RENTAL' THEN 'SOLD_BY' ELSE 'HAS_CATEGORY' END AS rel, 'Category' AS dst_label,
                          CASE WHEN size_no > 40 THEN 'no such' ELSE primary_category END AS dst_name FROM place)
    SELECT src, src_label, rel, dst_label, dst_name, CASE WHEN src_label <> 'Attraction' OR rel <> 'HAS_CATEGORY' THEN 'RELATION' ELSE 'VALUE' END AS problem
    FROM asked WHERE src_label <> 'Attraction' OR rel <> 'HAS_CATEGORY'
       OR dst_name NOT IN (SELECT name FROM node WHERE label = 'Category')""", ("node",))
def triplet_validate(t):
    label = F.coalesce(G.place_label(), F.lit("Restaurant"))
    asked = t.place.select(
        F.col("place_id").alias("src"), label.alias("src_label"),
        F.when(F.col("type") == "VACATION_RENTAL", "SOLD_BY").otherwise("HAS_CATEGORY").alias("rel"), F.lit("Category").alias("dst_label"),
        F.when(F.col("size_no") > 40, "no such").otherwise(F.col("primary_category")).alias("dst_name"))
    return G.invalid_triplets(asked, t.edge, t.node)
