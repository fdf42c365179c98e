"""Review analytics: de-duplication, caps, counts, distributions and place statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions import rules


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order``.

    An aggregate, not a ranking window: each task keeps one row per key, so a
    key that owns a third of the input never gathers in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def cap_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group in ``order``, exactly.

    Spark drops rows ranked above ``n`` in each task before shuffling, so a hot
    group sends at most ``n`` rows per task.
    """
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def newest(df: DataFrame, date: str, tie: Sequence[str], n: int = 1000) -> DataFrame:
    return df.orderBy(F.col(date).desc(), *[F.col(c) for c in tie]).limit(n)


def suffix_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner join; columns present on both sides get ``_x`` and ``_y``."""
    shared = (set(left.columns) & set(right.columns)) - {on}
    a = left.select(*[F.col(c).alias(f"{c}_x" if c in shared else c) for c in left.columns])
    b = right.select(*[F.col(c).alias(f"{c}_y" if c in shared else c) for c in right.columns])
    return a.join(b, on)


def value_counts(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Long form of a value distribution per group; missing values are not counted."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(*keys, F.col(column).alias("value")).agg(F.count("*").alias("n"))
    )


def facet_counts(df: DataFrame, keys: Sequence[str], facets: dict[str, str]) -> DataFrame:
    """value_counts of several columns in one pass: (keys, facet, value, n)."""
    pairs = ", ".join(f"'{facet}', cast({column} as string)" for facet, column in facets.items())
    long = df.select(*keys, F.expr(f"stack({len(facets)}, {pairs}) as (facet, value)"))
    return (
        long.filter(F.col("value").isNotNull())
        .groupBy(*keys, "facet", "value").agg(F.count("*").alias("n"))
    )


def entropy(n: Column) -> Column:
    """Entropy in nats of the counts in a group: ln(T) - sum(n ln n) / T."""
    total = F.sum(n)
    return F.log(total) - F.sum(n * F.log(n)) / total


def dominant(value: Column, n: Column) -> Column:
    """Most frequent value; the smaller value wins a tie."""
    return F.min_by(value, F.struct(-n, value))


def distribution_json(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One JSON object per group. Only for columns whose values come from a small catalogue."""
    entries = F.sort_array(F.collect_list(F.struct("value", "n")))
    return counts.groupBy(*keys).agg(F.to_json(F.map_from_entries(entries)).alias("distribution"))


def place_counts(review: DataFrame) -> DataFrame:
    return review.groupBy("place_id").agg(F.count("*").alias("n"), F.avg("rating").alias("mean_rating"))


def place_statistics(review: DataFrame) -> DataFrame:
    """Count, mean, Bayesian weighted rating and tiers per place.

    weighted = (n R + m C) / (n + m), m the mean count, C the mean rating. The
    popularity tier is the quartile of the review count; equal counts share a tier.
    """
    per_place = place_counts(review)
    overall = per_place.agg(
        F.avg("n").alias("m"),
        F.percentile("n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
        (F.sum(F.col("n") * F.col("mean_rating")) / F.sum("n")).alias("c"),
    ).select(F.struct("m", "q", "c")).scalar()
    rated = per_place.withColumn("_all", overall).withColumn(
        "weighted_rating",
        F.round((F.col("n") * F.col("mean_rating") + F.col("_all.m") * F.col("_all.c")) / (F.col("n") + F.col("_all.m")), 6),
    )
    above = [(F.col("n") > F.col("_all.q")[i]).cast("int") for i in range(3)]
    return rated.select(
        "place_id", "n", "mean_rating", "weighted_rating",
        rules.rating_tier(F.col("weighted_rating")).alias("rating_tier"),
        (1 + above[0] + above[1] + above[2]).cast("int").alias("popularity_tier"),
    )


def location_statistics(review: DataFrame, place: DataFrame) -> DataFrame:
    """Mean rating and rating count per (city, state); places without either key are left out.

    Reviews shrink to one row per place before they meet the place table.
    """
    sums = review.groupBy("place_id").agg(F.sum("rating").alias("s"), F.count("rating").alias("n"))
    located = place.filter(F.col("city").isNotNull() & F.col("state").isNotNull()).select("place_id", "city", "state")
    return sums.join(located, "place_id").groupBy("city", "state").agg(
        F.try_divide(F.sum("s"), F.sum("n")).alias("loc_avg_rating"), F.sum("n").alias("loc_review_count"))


def with_location_statistics(place: DataFrame, review: DataFrame) -> DataFrame:
    """Left join of the city table back to the places, with the log count."""
    joined = place.join(location_statistics(review, place), ["city", "state"], "left")
    return (
        joined.withColumn("loc_avg_rating", F.coalesce("loc_avg_rating", F.lit(0.0)))
        .withColumn("loc_log_count", F.log1p(F.coalesce("loc_review_count", F.lit(0))))
    )


def sentiment_by_category(review: DataFrame, place: DataFrame) -> DataFrame:
    """Reviews of known places by category and sentiment.

    Counts per place and rating are taken before the join, so the join moves a
    few rows per place instead of every review.
    """
    per_place = review.filter(F.col("rating").isNotNull()).groupBy("place_id", "rating").agg(
        F.count("*").alias("n"), F.sum("spend").alias("spend"))
    joined = per_place.join(place.select("place_id", "primary_category"), "place_id")
    return joined.groupBy("primary_category", rules.sentiment(F.col("rating")).alias("sentiment")).agg(
        F.sum("n").alias("n_reviews"),
        (F.sum(F.col("n") * F.col("rating")) / F.sum("n")).alias("mean_rating"),
        F.sum("spend").alias("spend"),
    )


def reviews_between(review: DataFrame, start, end) -> DataFrame:
    return review.filter(F.col("published").between(start, end))


def reviews_in_trip(trips: DataFrame, review: DataFrame, place: DataFrame) -> DataFrame:
    """Reviews of a trip's city on the trip's days: count and mean rating per trip.

    Reviews shrink to one row per place and day before they meet the places, and
    to one per city and day before the trips; a trip opens into its own days, so
    the range test becomes an equality join. A trip that ends before it starts
    has no days.
    """
    per_place = review.groupBy("place_id", F.col("published").alias("date")).agg(
        F.count("*").alias("n"), F.sum("rating").alias("rating_sum"))
    daily = per_place.join(place.select("place_id", "city"), "place_id").groupBy("city", "date").agg(
        F.sum("n").alias("n"), F.sum("rating_sum").alias("rating_sum"))
    days = trips.filter(F.col("start_date") <= F.col("end_date")).select("request_id", "city", F.explode(F.sequence("start_date", "end_date")).alias("date"))
    return (
        days.join(daily, ["city", "date"])
        .groupBy("request_id").agg(F.sum("n").alias("n_reviews"), F.sum("rating_sum").alias("rating_sum"))
        .select("request_id", "n_reviews", F.round(F.col("rating_sum") / F.col("n_reviews"), 6).alias("mean_rating"))
    )


# -- cluster profiles -------------------------------------------------------

PROFILE_KEYS = ("method", "label")
PROFILE_FACETS = {
    "category": "primary_category", "sentiment": "sentiment", "tier": "popularity_tier",
    "city": "city", "state": "state", "country": "country", "attraction": "place_name",
}


def without_noise(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label") >= 0)


def cluster_facets(df: DataFrame) -> DataFrame:
    """One row per cluster and facet: entropy, number of values, dominant value, and rating sums.

    A single pass over the reviews: they shrink to (cluster, facet, value)
    counts with rating sums, and everything in the profile comes from those.
    """
    facets = {**PROFILE_FACETS, "rating": "rating"}
    pairs = ", ".join(f"'{facet}', cast({column} as string)" for facet, column in facets.items())
    long = without_noise(df).select(
        *PROFILE_KEYS, F.col("rating").cast("double").alias("r"), F.col("weighted_rating").alias("w"),
        F.expr(f"stack({len(facets)}, {pairs}) as (facet, value)"))
    cells = long.filter(F.col("value").isNotNull()).groupBy(*PROFILE_KEYS, "facet", "value").agg(
        F.count("*").alias("n"), F.count("r").alias("rated"), F.sum("r").alias("s"), F.sum(F.col("r") * F.col("r")).alias("q"),
        F.min("r").alias("low"), F.max("r").alias("high"), F.sum("w").alias("w"), F.count("w").alias("weighted"))
    return cells.groupBy(*PROFILE_KEYS, "facet").agg(
        entropy(F.col("n")).alias("entropy"), F.count("*").alias("n_values"), dominant(F.col("value"), F.col("n")).alias("dominant"),
        F.sum("n").alias("size"), F.sum("rated").alias("rated"), F.sum("s").alias("s"), F.sum("q").alias("q"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("w").alias("w"), F.sum("weighted").alias("weighted"),
        F.percentile(F.col("value").try_cast("double"), F.lit(0.5), F.col("n")).alias("median"),
    )


def facet_columns(facets: DataFrame, wanted: dict[str, tuple[str, str]]) -> DataFrame:
    """Turn facet rows into columns: name -> (facet, measure)."""
    return facets.groupBy(*PROFILE_KEYS).agg(*[
        F.max(F.when(F.col("facet") == facet, F.col(measure))).alias(name)
        for name, (facet, measure) in wanted.items()
    ])


def cluster_profile(df: DataFrame) -> DataFrame:
    """Rating statistics, dominant values, distinct counts and entropies per cluster.

    Every review has a sentiment, so the sentiment facet carries the cluster's
    totals. A one-row cluster has standard deviation 0.
    """
    base = {m: ("sentiment", m) for m in ("size", "rated", "s", "q", "low", "high", "w", "weighted")}
    wide = facet_columns(cluster_facets(df), {
        **base, "median_rating": ("rating", "median"),
        "category_entropy": ("category", "entropy"), "dominant_category": ("category", "dominant"),
        "sentiment_entropy": ("sentiment", "entropy"), "dominant_sentiment": ("sentiment", "dominant"),
        "dominant_tier": ("tier", "dominant"),
        "n_city": ("city", "n_values"), "top_city": ("city", "dominant"), "city_entropy": ("city", "entropy"),
        "n_state": ("state", "n_values"), "top_state": ("state", "dominant"),
        "n_country": ("country", "n_values"), "top_country": ("country", "dominant"),
        "n_category": ("category", "n_values"), "n_sentiment": ("sentiment", "n_values"),
        "n_attraction": ("attraction", "n_values"),
    })
    spread = F.greatest(F.lit(0.0), F.col("q") - F.col("s") * F.col("s") / F.col("rated"))
    numbers = {
        "size": F.col("size"),
        "mean_rating": F.try_divide(F.col("s"), F.col("rated")),
        "median_rating": F.col("median_rating"),
        "std_rating": F.coalesce(F.sqrt(F.try_divide(spread, F.col("rated") - 1)), F.lit(0.0)),
        "min_rating": F.col("low"), "max_rating": F.col("high"),
        "weighted_avg": F.try_divide(F.col("w"), F.col("weighted")),
    }
    used = {*base, "median_rating", *PROFILE_KEYS}
    return wide.select(*PROFILE_KEYS, *[value.alias(name) for name, value in numbers.items()], *[c for c in wide.columns if c not in used])


def cluster_quality(profile: DataFrame) -> DataFrame:
    """Cohesion, consistency, diversity and their mean. Cohesion may fall below zero: entropy is in nats."""
    parts = profile.select(
        *PROFILE_KEYS, "size",
        (1 - F.col("category_entropy")).alias("category_cohesion"),
        (1 - F.col("sentiment_entropy")).alias("sentiment_cohesion"),
        (1 / (1 + F.col("std_rating"))).alias("rating_consistency"),
        F.col("city_entropy").alias("location_diversity"),
        F.log(F.greatest(F.lit(2), F.col("n_city")).cast("double")).alias("_max_diversity"),
    )
    overall = (
        F.col("category_cohesion") + F.col("sentiment_cohesion") + F.col("rating_consistency")
        + 1 - F.col("location_diversity") / F.col("_max_diversity")
    ) / 4
    return parts.withColumn("overall_quality_score", overall).drop("_max_diversity")


def cluster_summary(quality: DataFrame) -> DataFrame:
    return quality.groupBy("method").agg(
        F.count("*").alias("total_clusters"),
        F.sum("size").alias("total_points"),
        F.avg("size").alias("avg_cluster_size"),
        F.stddev_pop("size").alias("std_cluster_size"),
        F.min("size").alias("min_cluster_size"),
        F.max("size").alias("max_cluster_size"),
        F.avg("overall_quality_score").alias("avg_quality_score"),
    )


def dataset_statistics(df: DataFrame, facets: Sequence[str], date: str) -> DataFrame:
    """Totals and per-facet counts with the date range, all from one grouping-sets pass."""
    sets = [[F.col(f)] for f in facets] + [[]]
    grouped = df.groupingSets(sets, *[F.col(f) for f in facets]).agg(
        F.grouping_id().alias("_gid"), F.count("*").alias("n"),
        F.min(date).alias("earliest"), F.max(date).alias("latest"),
    )
    width = len(facets)
    name, value = F.lit("total"), F.lit("all")
    for position, facet in enumerate(facets):
        only = (1 << width) - 1 - (1 << (width - 1 - position))
        name = F.when(F.col("_gid") == only, facet).otherwise(name)
        value = F.when(F.col("_gid") == only, F.col(facet).cast("string")).otherwise(value)
    return grouped.select(name.alias("facet"), value.alias("value"), "n", "earliest", "latest")
