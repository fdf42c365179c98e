"""Whole jobs put together from the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare import schemas
from wayfare.functions import rules
from wayfare.operators import cluster as C
from wayfare.operators import features as X
from wayfare.operators import ingest
from wayfare.operators import reviews as R
from wayfare.operators.reviews import cap_per_group, first_per_key, suffix_join
from wayfare.sources import readers, writers

# Metadata of an embedding row beyond name, place, review and rating.
EXTRA_METADATA = {"price_category": "string", "latitude": "double", "longitude": "double", "restaurant_tier": "string",
                  "review_title": "string", "dietary_restrictions": "string"}
REVIEW_FAMILIES = {
    "hotel": (ingest.hotel_reviews, schemas.HOTEL_SUBRATINGS),
    "restaurant": (ingest.restaurant_reviews, schemas.RESTAURANT_SUBRATINGS),
}


def load_reviews(spark: SparkSession, source: str, target: str, family: str) -> DataFrame:
    """Nested review documents into a typed table with rejects kept; returns the good rows."""
    flatten, subratings = REVIEW_FAMILIES[family]
    spec = schemas.review_spec(subratings)
    writers.load_table(flatten(readers.read_reviews(spark, source, keep_broken=True)), spec, target, broken="record")
    return writers.loaded_rows(spark, target, spec)


def load_places(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Place documents into one audited table, a folder per family, in one pass; returns the good rows.

    Lines that are no documents and rows with values that do not fit their type
    land in the folder ``rejected`` with their text (see ``rejected_places``).
    """
    checked = ingest.tagged_places(readers.read_places(spark, source, keep_broken=True))
    folder = F.when(F.size("_rejected") > 0, writers.REJECTED).otherwise(F.col("category"))
    writers.with_audit(checked).withColumn("category", folder).write.mode("append").partitionBy("category").parquet(target)
    return spark.read.parquet(target).filter(F.col("category") != writers.REJECTED).drop("_rejected", "_raw")


def rejected_places(spark: SparkSession, target: str) -> DataFrame:
    """(_raw, _rejected) of the rows that ``load_places`` did not take."""
    return spark.read.parquet(target).filter(F.col("category") == writers.REJECTED).select("_raw", "_rejected")


def embedding_rows(place: DataFrame, review: DataFrame, place_order: Sequence[str], review_order: Sequence[str], namespace: str) -> DataFrame:
    """Rows for the vector index: first row per place and per review, joined, with text and metadata.

    ``place(place_id, name, cuisines, city, state, rating)``,
    ``review(review_id, place_id, city, state, rating, review_text, review_date, trip_type)``;
    the other metadata (price category, coordinates, tier, dietary restrictions, review title) is null where
    neither table has it.
    """
    places = first_per_key(place.withColumn("place_id", F.col("place_id").cast("string")), ["place_id"], place_order)
    reviews = first_per_key(review.withColumn("place_id", F.col("place_id").cast("string")), ["review_id"], review_order)
    joined = suffix_join(places, reviews, "place_id")
    metadata = F.struct(
        F.col("name"), F.col("city_y").alias("city"), F.col("state_x").alias("state"), F.col("rating_x").alias("rating"),
        F.col("cuisines"), F.col("review_date"), F.col("review_text"), F.col("trip_type"),
        *[(F.col(c) if c in joined.columns else F.lit(None).cast(kind)).alias(c) for c, kind in EXTRA_METADATA.items()])
    return joined.select(
        F.concat_ws("_", "place_id", "review_id").alias("id"), F.lit(namespace).alias("namespace"),
        ingest.embed_text(F.col("name"), F.col("cuisines"), F.col("review_text")).alias("text"), metadata.alias("metadata"))


def cluster_features(rows: DataFrame, dim: int, reduced: int) -> DataFrame:
    """Reduced vectors, one-hot and rating blocks, weighed and joined: adds the array ``features``."""
    return X.combine(X.encode(X.reduce_vectors(rows, "vector", dim, reduced)))


def cluster_tables(rows: DataFrame, points: DataFrame, starts: int = C.STARTS) -> dict[str, DataFrame]:
    """Cluster the points every way that works and derive all tables from the labels.

    ``points(id, vector)`` are the combined features of ``rows(id, place_id, ...)``.
    """
    labelled = [
        df.select("id", "vector", F.col("label").cast("long").alias("label")).withColumn("method", F.lit(method))
        for method, (df, _) in C.cluster_rows(points, starts).items()
    ]
    assigned = reduce(lambda a, b: a.unionByName(b), labelled)
    described = rows.join(assigned.select("id", "method", "label"), "id")
    profile = R.cluster_profile(described)
    quality = R.cluster_quality(profile)
    cluster_id = F.concat_ws("_", "method", F.col("label").cast("string"))
    members = R.without_noise(described).groupBy(F.col("place_id").alias("src"), cluster_id.alias("dst"), "method").agg(F.count("*").alias("n_reviews"))
    return {
        "assignments": assigned.select("id", "method", "label"),
        "profile": profile, "quality": quality, "summary": R.cluster_summary(quality),
        "nodes": profile.withColumn("cluster_id", cluster_id), "in_cluster": members, "related": C.related(assigned),
    }


def stays_in_budget(trips: DataFrame, hotels: DataFrame, k: int = 2) -> DataFrame:
    """The ``k`` best rated hotels of a trip's city in the tier its budget allows per night.

    ``trips(request_id, location, budget, n_days)``, ``hotels(city, place_id, name, rating, night_price)``.
    Hotels are ranked once per city and tier; trips join on both.
    """
    hotel_share, _ = rules.split_budget(F.col("budget"))
    asked = trips.filter(F.col("location").isNotNull() & F.col("budget").isNotNull() & (F.col("n_days") > 0)).select(
        "request_id", F.col("location").alias("city"), rules.tier_below(hotel_share / F.col("n_days"), rules.HOTEL_TIERS).alias("tier"))
    ranked = cap_per_group(
        hotels.withColumn("tier", rules.tier_below(F.col("night_price"), rules.HOTEL_TIERS)), ["city", "tier"],
        [F.col("rating").desc(), F.col("place_id")], k, rank="choice")
    return asked.join(ranked.select("city", "tier", "choice", "place_id", "name"), ["city", "tier"])
