"""Queries over whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfare import jobs
from wayfare.operators import requests as Q
from wayfare.plans.requests import _ENTITIES
from wayfare.registry import query


@query("embedding_load", """
    WITH once AS (SELECT * FROM review QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY published, place_id, user_id, spend) = 1)
    SELECT concat_ws('_', p.place_id, r.review_id) AS id, 'restaurants' AS namespace,
           concat_ws(' ', p.name, p.brand, concat(r.trip_type, r.status)) AS text, u.n_name AS city, p.state, p.price AS rating,
           r.published AS review_date
    FROM once r JOIN place p ON r.place_id = p.place_id JOIN supplier s ON r.user_id = CAST(s.s_suppkey AS VARCHAR)
    JOIN nation u ON s.s_nationkey = u.n_nationkey WHERE p.type = 'RESTAURANT'""", ("place", "review"))
def embedding_load(t):
    """Rows for the vector index; reviews carry the city of their writer."""
    users = t.table("supplier").join(t.cities, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("user_id"), "city", "state")
    places = t.place.filter(F.col("type") == "RESTAURANT").select(
        "place_id", "name", F.col("brand").alias("cuisines"), "city", "state", F.col("price").alias("rating"))
    reviews = t.review.join(users, "user_id").select(
        "review_id", "place_id", "city", "state", F.col("rating").cast("double").alias("rating"),
        F.concat("trip_type", "status").alias("review_text"), F.col("published").alias("review_date"), "trip_type", "user_id", "spend")
    rows = jobs.embedding_rows(places, reviews, ["name"], ["review_date", "place_id", "user_id", "spend"], "restaurants")
    return rows.select("id", "namespace", "text", "metadata.city", "metadata.state", "metadata.rating", "metadata.review_date")


@query("stays_in_budget", _ENTITIES + """
    , hotels AS (SELECT city, p.place_id, name, mean_rating, CASE WHEN price - 800 < 100 THEN 'BUDGET' WHEN price - 800 < 200 THEN 'MIDRANGE'
                        WHEN price - 800 < 300 THEN 'UPSCALE' ELSE 'LUXURY' END AS tier
                 FROM place p JOIN place_stats s ON p.place_id = s.place_id WHERE type = 'HOTEL'),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY city, tier ORDER BY mean_rating DESC, place_id) AS choice FROM hotels QUALIFY choice <= 2),
    asked AS (SELECT request_id, location, round(CAST(budget AS DECIMAL(18, 2)) * 0.7, 2)::DOUBLE / n_days AS night FROM said
              WHERE location IS NOT NULL AND budget IS NOT NULL AND n_days > 0)
    SELECT request_id, city, tier, CAST(choice AS INTEGER) AS choice, place_id, name FROM asked JOIN ranked ON city = location
        AND tier = CASE WHEN night < 100 THEN 'BUDGET' WHEN night < 200 THEN 'MIDRANGE' WHEN night < 300 THEN 'UPSCALE' ELSE 'LUXURY' END""",
       ("place", "place_stats"))
def stays_in_budget(t):
    """Two hotels per request, from the free text to the tier its budget allows."""
    hotels = t.place.filter(F.col("type") == "HOTEL").join(
        t.place_stats.select("place_id", F.col("mean_rating").alias("rating")), "place_id").withColumn("night_price", F.col("price") - 800)
    return jobs.stays_in_budget(Q.entities(t.request, t.cities), hotels)
