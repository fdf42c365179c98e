"""Candidates of both sources put together, and a day-by-day plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.operators.reviews import cap_per_group

# Fixed value: hotels offered per plan.
HOTELS = 2


def union_candidates(graph: DataFrame, vector: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """One row per request and candidate, with the sources that named it and the best score."""
    tagged = graph.withColumn("source", F.lit("graph")).unionByName(vector.withColumn("source", F.lit("vector")))
    return tagged.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), F.max(score).alias("best_score"))


def ranked_places(place: DataFrame, most: int) -> DataFrame:
    """The ``most`` best rated places per city and type, numbered."""
    order = [F.col("rating").desc(), F.col("place_id")]
    return cap_per_group(place, ["city", "type"], order, most, rank="place_rank")


def day_plan(trips: DataFrame, place: DataFrame) -> DataFrame:
    """Two hotels per trip and one attraction and one restaurant per day.

    ``trips(request_id, city, n_days)``, ``place(city, type, place_id, name, price, rating)``;
    day d takes the place ranked d in the trip's city, starting over when the
    city has fewer places than the trip has days. Ranks beyond the longest trip
    are never asked for, so no more are kept. All joins are on (city, type, rank).
    """
    longest = trips.agg(F.max("n_days")).first()[0] or 0
    ranked = ranked_places(place, max(longest, HOTELS))
    available = ranked.groupBy("city", "type").agg(F.max("place_rank").alias("n_places"))
    slots = trips.select("request_id", "city", F.explode(F.concat(
        F.transform(F.sequence(F.lit(1), F.lit(HOTELS)), lambda i: F.struct(F.lit("HOTEL").alias("type"), F.lit(0).alias("day"), i.alias("slot"))),
        F.transform(F.sequence(F.lit(1), F.col("n_days")), lambda d: F.struct(F.lit("ATTRACTION").alias("type"), d.alias("day"), d.alias("slot"))),
        F.transform(F.sequence(F.lit(1), F.col("n_days")), lambda d: F.struct(F.lit("RESTAURANT").alias("type"), d.alias("day"), d.alias("slot"))),
    )).alias("s")).select("request_id", "city", "s.*")
    chosen = slots.join(available, ["city", "type"]).filter((F.col("type") != "HOTEL") | (F.col("slot") <= F.col("n_places")))
    chosen = chosen.withColumn("place_rank", (F.pmod(F.col("slot") - 1, F.col("n_places")) + 1).cast("int"))
    return chosen.join(ranked.select("city", "type", "place_rank", "place_id", "name", "price"), ["city", "type", "place_rank"]).select(
        "request_id", "city", "day", "type", "place_id", "name", "price")


def daily_spend(plan: DataFrame) -> DataFrame:
    return plan.filter(F.col("day") > 0).groupBy("request_id", "day").agg(F.sum("price").alias("spend"), F.count("*").alias("n_stops"))


def to_lists(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Parallel lists per group, in one common order. For groups already cut to a few rows."""
    rows = F.sort_array(F.collect_list(F.struct(order, *columns)))
    packed = df.groupBy(*keys).agg(rows.alias("_r"))
    return packed.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in [order, *columns]])


def from_lists(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Back to one row per list position."""
    return df.select(*keys, F.explode(F.arrays_zip(*columns)).alias("_r")).select(*keys, "_r.*")
