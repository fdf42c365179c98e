"""Plan for generated reviews: quotas, parameters, prompts and row layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions import rules

# What a generated review may vary in. (style, length, focus, words)
STYLES = (
    ("detailed", "long", "comprehensive analysis", "400-600 words"),
    ("concise", "short", "key highlights", "100-200 words"),
    ("balanced", "medium", "main points with detail", "250-350 words"),
    ("emotional", "medium", "personal experience", "250-350 words"),
    ("practical", "medium", "tips and advice", "250-350 words"),
)
ASPECTS = (
    "value for money and costs",
    "crowd levels and best times to visit",
    "cleanliness and maintenance",
    "staff service and helpfulness",
    "facilities and amenities",
    "accessibility and convenience",
    "authenticity and cultural aspects",
    "atmosphere and overall experience",
    "safety and security measures",
    "photo opportunities and scenery",
    "food and beverage options",
    "parking and transportation",
    "restroom availability and condition",
    "signage and wayfinding",
    "special features or unique offerings",
)
VISITORS = (
    ("budget traveler", "value, affordable options, cost-effectiveness"),
    ("luxury seeker", "premium experience, quality service, exclusivity"),
    ("family visitor", "child-friendly, safety, entertainment"),
    ("photography enthusiast", "photo spots, lighting, views"),
    ("history buff", "historical accuracy, information, preservation"),
    ("adventure seeker", "excitement, unique experiences, activities"),
    ("relaxation focused", "comfort, peaceful atmosphere, amenities"),
    ("cultural explorer", "authenticity, local insights, traditions"),
    ("accessibility concerned", "facilities, movement ease, support"),
    ("time-constrained visitor", "efficiency, highlights, organization"),
)
REQUIRED = ("rating", "title", "review_text", "trip_type", "travel_date")
FEWEST_ASPECTS, MOST_ASPECTS = 2, 4
# Rows one task step opens at once.
CHUNK = 10_000


def quotas(review: DataFrame, place_ids: DataFrame, real_share: float = rules.REAL_SHARE) -> DataFrame:
    """Generated rows wanted per known place, and the percentages of the final mix."""
    counts = review.groupBy("place_id").agg(F.count("*").alias("n_real")).join(place_ids, "place_id", "left_semi")
    wanted = counts.withColumn("n_synthetic", rules.synthetic_quota(F.col("n_real"), real_share))
    total = F.col("n_real") + F.col("n_synthetic")
    return wanted.withColumn("real_percent", F.round(100 * F.col("n_real") / total, 1)).withColumn(
        "synthetic_percent", F.round(100 * F.col("n_synthetic") / total, 1))


def open_rows(quota: DataFrame) -> DataFrame:
    """One row per review to generate: (place_id, seq).

    A quota opens in two steps, chunks first, so a place with a huge quota is
    spread over tasks.
    """
    chunks = quota.select(
        "place_id", "n_synthetic",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_synthetic") - 1) / CHUNK))).alias("chunk"))
    first = F.col("chunk") * CHUNK + 1
    last = F.least(F.col("n_synthetic"), (F.col("chunk") + 1) * CHUNK)
    return chunks.repartition("place_id", "chunk").select("place_id", F.explode(F.sequence(first, last)).alias("seq"))


def _digest(*extra) -> Column:
    return F.md5(F.concat_ws("|", "place_id", F.col("seq").cast("string"), *extra))


def _pick(salt: str, n: int) -> Column:
    """A number below ``n`` from the first eight hex digits of the row's digest."""
    return F.pmod(F.conv(F.substring(_digest(F.lit(salt)), 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")


def _choice(values, salt: str, names) -> Column:
    rows = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(names, row)]) for row in values])
    return F.get(rows, _pick(salt, len(values)))


def with_parameters(rows: DataFrame, salt: str = "") -> DataFrame:
    """Style, visitor and aspects drawn from a hash of place and number: a rerun draws the same."""
    keyed = F.transform(
        F.array(*[F.lit(a) for a in ASPECTS]),
        lambda a: F.struct(_digest(F.lit(salt + "aspect"), a).alias("k"), a.alias("a")))
    n_aspects = FEWEST_ASPECTS + _pick(salt + "count", MOST_ASPECTS - FEWEST_ASPECTS + 1)
    return (
        rows.withColumn("_style", _choice(STYLES, salt + "style", ("style", "length", "focus", "words")))
        .withColumn("_visitor", _choice(VISITORS, salt + "visitor", ("visitor", "expects")))
        .withColumn("aspects", F.transform(F.slice(F.array_sort(keyed), F.lit(1), n_aspects), lambda x: x["a"]))
        .select(*rows.columns, "_style.*", "_visitor.*", "aspects")
    )


def rating_context(mean: Column) -> Column:
    return F.when(mean.isNull(), "Rate the visit as it is described.").otherwise(
        F.concat(F.lit("Visitors give this place about "), F.format_number(mean, 1), F.lit(" stars.")))


def prompts(rows: DataFrame) -> DataFrame:
    """Prompt text per row from (name, location, categories, avg_rating) and the drawn parameters."""
    lines = [
        F.concat_ws(" ", F.lit("Write a"), "length", F.lit("review of"), "words", F.lit("for a place.")),
        F.concat(F.lit("Name: "), F.col("name")),
        F.concat(F.lit("Location: "), F.col("location")),
        F.concat(F.lit("Categories: "), F.col("categories")),
        F.concat_ws(" ", F.lit("Style:"), "style", F.lit("with a view to"), "focus"),
        F.concat_ws(" ", F.lit("Written by a"), "visitor", F.lit("who expects"), "expects"),
        F.concat(F.lit("Cover: "), F.array_join("aspects", ", ")),
        rating_context(F.col("avg_rating")),
        F.concat(F.lit("Answer with one JSON object with the fields "), F.lit(", ".join(REQUIRED)), F.lit(".")),
    ]
    return rows.withColumn("prompt", F.concat_ws("\n", *lines))


def missing_reply_fields(reply: Column) -> Column:
    """Required fields a JSON reply lacks; a reply that is no JSON lacks all of them."""
    keys = F.coalesce(F.json_object_keys(reply), F.array().cast("array<string>"))
    return F.array_except(F.array(*[F.lit(f) for f in REQUIRED]), keys)


def synthetic_rows(rows: DataFrame, run_date: Column) -> DataFrame:
    """Rows in table layout; id and user are hashes of place and number, so a rerun replaces its own rows."""
    digest = F.sha2(F.concat_ws("|", "place_id", F.col("seq").cast("string")), 256)
    return rows.select(
        digest.alias("id"), F.col("place_id").alias("locationid"), F.col("rating"), F.col("title"), F.col("text"), F.col("trip_type"),
        F.col("traveldate"), run_date.alias("publisheddate"),
        F.concat(F.lit("user_"), F.substring(digest, 1, 10)).alias("username"), F.col("userlocation"),
    )
