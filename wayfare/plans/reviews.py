"""Joins, aggregates, rankings and cluster profiles over the review views."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfare.functions import rules
from wayfare.operators import reviews as R
from wayfare.registry import query


@query("sentiment_join", """
    SELECT p.primary_category, CASE WHEN r.rating >= 4 THEN 'POSITIVE' WHEN r.rating <= 2 THEN 'NEGATIVE'
                                    ELSE 'NEUTRAL' END AS sentiment,
           count(*) AS n_reviews, round(avg(r.rating), 6) AS mean_rating, round(sum(r.spend), 2) AS spend
    FROM review r JOIN place p ON r.place_id = p.place_id
    WHERE r.rating IS NOT NULL GROUP BY ALL""", ("place", "review"))
def sentiment_join(t):
    return R.sentiment_by_category(t.review, t.place).withColumn("mean_rating", F.round("mean_rating", 6)).withColumn(
        "spend", F.round("spend", 2))


@query("sentiment_case", """
    SELECT review_id, place_id, rating, CASE WHEN rating >= 4 THEN 'POSITIVE' WHEN rating <= 2 THEN 'NEGATIVE'
                                             ELSE 'NEUTRAL' END AS sentiment FROM review""", ("review",))
def sentiment_case(t):
    return t.review.select("review_id", "place_id", "rating", rules.sentiment(F.col("rating")).alias("sentiment"))


@query("suffix_join", """
    SELECT r.place_id, r.review_id, p.name AS name, r.rating, p.city AS city_x, u.n_name AS city_y,
           p.place_no, r.user_id
    FROM review r JOIN place p ON r.place_id = p.place_id
    JOIN supplier s ON r.user_id = CAST(s.s_suppkey AS VARCHAR) JOIN nation u ON s.s_nationkey = u.n_nationkey""",
       ("place", "review"))
def suffix_join(t):
    users = t.table("supplier").join(t.cities, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("user_id"), "city"
    )
    written = t.review.select("review_id", "place_id", "rating", "user_id").join(users, "user_id")
    return R.suffix_join(t.place.select("place_id", "place_no", "name", "city"), written, "place_id")


@query("location_stats", """
    WITH rated AS (SELECT p.city, p.state, r.rating FROM review r JOIN place p ON r.place_id = p.place_id),
         loc AS (SELECT city, state, avg(rating) AS a, count(rating) AS c FROM rated GROUP BY city, state)
    SELECT p.place_id, p.city, p.state, round(coalesce(a, 0.0), 6) AS loc_avg_rating, c AS loc_review_count,
           round(ln(1 + coalesce(c, 0)), 6) AS loc_log_count
    FROM place p LEFT JOIN loc ON p.city = loc.city AND p.state = loc.state""", ("place", "review"))
def location_stats(t):
    return R.with_location_statistics(t.place, t.review).select(
        "place_id", "city", "state", F.round("loc_avg_rating", 6).alias("loc_avg_rating"), "loc_review_count",
        F.round("loc_log_count", 6).alias("loc_log_count"))


@query("place_statistics", "SELECT place_id, n, round(mean_rating, 6) AS mean_rating, weighted_rating, rating_tier, "
       "CAST(popularity_tier AS INTEGER) AS popularity_tier FROM place_stats", ("place_stats",))
def place_statistics(t):
    return t.place_stats.withColumn("mean_rating", F.round("mean_rating", 6))


@query("semi_valid_ids", """
    SELECT place_id, count(*) AS n FROM review
    WHERE place_id IN (SELECT place_id FROM place WHERE type = 'ATTRACTION') GROUP BY place_id""", ("place", "review"))
def semi_valid_ids(t):
    valid = t.place.filter(F.col("type") == "ATTRACTION").select("place_id")
    return R.place_counts(t.review).select("place_id", "n").join(valid, "place_id", "left_semi")


@query("string_keys", """
    SELECT p.place_id, count(*) AS n FROM part JOIN review p ON CAST(p_partkey AS VARCHAR) = p.place_id
    GROUP BY p.place_id""", ("review",))
def string_keys(t):
    parts = t.table("part").select(F.col("p_partkey").cast("string").alias("place_id"))
    return R.place_counts(t.review).select("place_id", "n").join(parts, "place_id")


@query("date_range", """
    WITH daily AS (SELECT p.city, r.published, count(*) AS n, sum(r.rating) AS s
                   FROM review r JOIN place p ON r.place_id = p.place_id GROUP BY ALL),
         trip AS (SELECT o_orderkey AS request_id, n_name AS city, CAST(o_orderdate AS DATE) AS a,
                         CAST(o_orderdate AS DATE) + CAST(2 + o_orderkey % 9 AS INTEGER) AS b
                  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
    SELECT request_id, CAST(sum(n) AS BIGINT) AS n_reviews, round(sum(s) / sum(n), 6) AS mean_rating
    FROM trip JOIN daily ON trip.city = daily.city AND daily.published BETWEEN trip.a AND trip.b
    GROUP BY request_id""", ("place", "review"))
def date_range(t):
    return R.reviews_in_trip(t.trip, t.review, t.place)


@query("review_counts", "SELECT place_id, count(*) AS review_count FROM review GROUP BY place_id", ("review",))
def review_counts(t):
    return t.review.groupBy("place_id").agg(F.count("*").alias("review_count"))


@query("rating_context", """
    WITH newest AS (SELECT * FROM review ORDER BY published DESC, order_no, line_no, place_id, user_id, spend LIMIT 1000),
         sample AS (SELECT place_id, avg(rating) AS a, count(*) AS n FROM newest GROUP BY place_id)
    SELECT p.place_id, coalesce(n, 0) AS n_sample, round(a, 6) AS avg_rating,
           CASE WHEN a IS NULL THEN 'NO SAMPLE' ELSE 'SAMPLE' END AS context
    FROM place p LEFT JOIN sample s ON p.place_id = s.place_id""", ("place", "review"))
def rating_context(t):
    sample = R.newest(t.review, "published", ["order_no", "line_no", "place_id", "user_id", "spend"])
    averages = sample.groupBy("place_id").agg(F.avg("rating").alias("a"), F.count("*").alias("n"))
    return t.place.select("place_id").join(averages, "place_id", "left").select(
        "place_id", F.coalesce("n", F.lit(0)).alias("n_sample"), F.round("a", 6).alias("avg_rating"),
        F.when(F.col("a").isNull(), "NO SAMPLE").otherwise("SAMPLE").alias("context"),
    )


# -- rankings and sets --------------------------------------------------------

@query("dedupe_first", """
    SELECT review_id, order_no, line_no, place_id, user_id, rating, published, trip_type, status, spend
    FROM review QUALIFY row_number() OVER (PARTITION BY review_id
        ORDER BY published, place_id, user_id, spend, rating) = 1""", ("review",))
def dedupe_first(t):
    return R.first_per_key(t.review, ["review_id"], ["published", "place_id", "user_id", "spend", "rating"])


@query("dedupe_report", """
    SELECT 'review' AS stage, count(*) AS n_rows, count(DISTINCT review_id) AS n_keys FROM review
    UNION ALL SELECT 'place', count(*), count(DISTINCT place_id) FROM place
    UNION ALL SELECT 'merged', count(*), count(DISTINCT r.review_id)
    FROM review r JOIN place p ON r.place_id = p.place_id""", ("place", "review"))
def dedupe_report(t):
    def line(stage, df, key):
        return df.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys")).select(
            F.lit(stage).alias("stage"), "n_rows", "n_keys")

    review = t.review.select("review_id", "place_id")
    place = t.place.select("place_id")
    return (
        line("review", review, "review_id")
        .unionByName(line("place", place, "place_id"))
        .unionByName(line("merged", review.join(place, "place_id"), "review_id"))
    )


_CAP_SQL = """
    SELECT review_id, place_id, rating, published, user_id, spend FROM review
    QUALIFY row_number() OVER (PARTITION BY place_id, rating
        ORDER BY published DESC, review_id, user_id, spend) <= 10"""


@query("cap_per_rating", _CAP_SQL, ("review",))
def cap_per_rating(t):
    rows = t.review.select("review_id", "place_id", "rating", "published", "user_id", "spend")
    order = [F.col("published").desc(), F.col("review_id"), F.col("user_id"), F.col("spend")]
    return R.cap_per_group(rows, ["place_id", "rating"], order, 10)


@query("union_ratings", """
    SELECT rating, count(*) AS n, count(DISTINCT place_id) AS n_places FROM review
    WHERE rating IN (1, 2, 3, 4, 5) GROUP BY rating""", ("review",))
def union_ratings(t):
    """The five per-rating extracts put together read as one membership filter: one scan instead of five."""
    return t.review.filter(F.col("rating").isin(1, 2, 3, 4, 5)).groupBy("rating").agg(
        F.count("*").alias("n"), F.count_distinct("place_id").alias("n_places"))


@query("newest_n", """
    SELECT review_id, place_id, rating, trip_type, published, user_id, spend FROM review
    ORDER BY published DESC, order_no, line_no, place_id, user_id, spend LIMIT 1000""", ("review",))
def newest_n(t):
    sample = R.newest(t.review, "published", ["order_no", "line_no", "place_id", "user_id", "spend"])
    return sample.select("review_id", "place_id", "rating", "trip_type", "published", "user_id", "spend")


@query("peek_rows", "SELECT place_id, name, city, state FROM place ORDER BY place_no LIMIT 5", ("place",))
def peek_rows(t):
    return t.place.orderBy("place_no").limit(5).select("place_id", "name", "city", "state")


# -- distributions ------------------------------------------------------------

@query("value_counts", """
    SELECT label, 'category' AS facet, primary_category AS value, count(*) AS n FROM clustered GROUP BY ALL
    UNION ALL SELECT label, 'sentiment', sentiment, count(*) FROM clustered GROUP BY ALL
    UNION ALL SELECT label, 'tier', CAST(popularity_tier AS VARCHAR), count(*) FROM clustered GROUP BY ALL
    UNION ALL SELECT label, 'city', city, count(*) FROM clustered GROUP BY ALL
    UNION ALL SELECT label, 'state', state, count(*) FROM clustered GROUP BY ALL
    UNION ALL SELECT label, 'country', country, count(*) FROM clustered GROUP BY ALL
    UNION ALL SELECT label, 'attraction', place_name, count(*) FROM clustered GROUP BY ALL""", ("clustered",))
def value_counts(t):
    return R.facet_counts(R.without_noise(t.clustered), ["label"], R.PROFILE_FACETS)


@query("value_shares", """
    SELECT place_id, rating AS value, count(*) AS n,
           round(count(*) / sum(count(*)) OVER (PARTITION BY place_id), 6) AS share
    FROM review GROUP BY place_id, rating""", ("review",))
def value_shares(t):
    counts = R.value_counts(t.review, ["place_id"], "rating")
    totals = counts.groupBy("place_id").agg(F.sum("n").alias("total"))
    return counts.join(totals, "place_id").select(
        "place_id", "value", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


@query("top_values", """
    WITH counts AS (SELECT label, city, count(*) AS n FROM clustered GROUP BY label, city)
    SELECT label, city AS value, n, row_number() OVER (PARTITION BY label ORDER BY n DESC, city) AS value_rank
    FROM counts QUALIFY value_rank <= 10""", ("clustered",))
def top_values(t):
    counts = R.value_counts(R.without_noise(t.clustered), ["label"], "city")
    capped = R.cap_per_group(counts, ["label"], [F.col("n").desc(), F.col("value")], 10, rank="value_rank")
    return capped.withColumn("value_rank", F.col("value_rank").cast("long"))


# Facet -> how many of its values a cluster shows.
TOP_FACETS = {"city": 10, "state": 10, "country": 5, "place_name": 10, "primary_category": 10}


@query("top_facets", " UNION ALL ".join(f"""
    SELECT '{c}' AS facet, * FROM (SELECT label, CAST({c} AS VARCHAR) AS value, count(*) AS n,
        row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, {c}) AS value_rank FROM clustered GROUP BY label, {c}) WHERE value_rank <= {k}"""
    for c, k in TOP_FACETS.items()), ("clustered",))
def top_facets(t):
    """Most frequent places, cities, states, countries and categories of each cluster, all counted in one pass."""
    facets = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"), F.lit(k).alias("most")) for c, k in TOP_FACETS.items()])
    opened = R.without_noise(t.clustered).select("label", F.explode(facets).alias("f")).select("label", "f.*")
    counts = opened.groupBy("label", "facet", "most", "value").agg(F.count("*").alias("n"))
    ranked = R.cap_per_group(counts, ["label", "facet"], [F.col("n").desc(), F.col("value")], max(TOP_FACETS.values()), rank="value_rank")
    return ranked.filter(F.col("value_rank") <= F.col("most")).select("facet", "label", "value", "n", F.col("value_rank").cast("long").alias("value_rank"))


@query("dominant_value", """
    WITH counts AS (SELECT place_id, trip_type, count(*) AS n FROM review GROUP BY place_id, trip_type)
    SELECT place_id, trip_type AS dominant, n FROM counts
    QUALIFY row_number() OVER (PARTITION BY place_id ORDER BY n DESC, trip_type) = 1""", ("review",))
def dominant_value(t):
    counts = R.value_counts(t.review, ["place_id"], "trip_type")
    return counts.groupBy("place_id").agg(
        R.dominant(F.col("value"), F.col("n")).alias("dominant"), F.max("n").alias("n"))


@query("dataset_stats", """
    SELECT 'total' AS facet, 'all' AS value, count(*) AS n, min(published) AS earliest, max(published) AS latest FROM review
    UNION ALL SELECT 'rating', CAST(rating AS VARCHAR), count(*), min(published), max(published) FROM review GROUP BY rating
    UNION ALL SELECT 'trip_type', trip_type, count(*), min(published), max(published) FROM review GROUP BY trip_type
    UNION ALL SELECT 'place_id', place_id, count(*), min(published), max(published) FROM review GROUP BY place_id""",
       ("review",))
def dataset_stats(t):
    rows = t.review.select("rating", "trip_type", "place_id", "published")
    return R.dataset_statistics(rows, ["rating", "trip_type", "place_id"], "published")


@query("catalogue_values", """
    SELECT DISTINCT 'Category' AS kind, primary_category AS value FROM place WHERE type = 'ATTRACTION'
    UNION ALL SELECT DISTINCT 'City', city FROM place WHERE type <> 'VACATION_RENTAL'
    UNION ALL SELECT DISTINCT 'Cuisine', brand FROM place WHERE type = 'RESTAURANT'""", ("place",))
def catalogue_values(t):
    pairs = F.explode(F.array_compact(F.array(
        F.when(F.col("type") == "ATTRACTION", F.struct(F.lit("Category").alias("kind"), F.col("primary_category").alias("value"))),
        F.when(F.col("type") != "VACATION_RENTAL", F.struct(F.lit("City").alias("kind"), F.col("city").alias("value"))),
        F.when(F.col("type") == "RESTAURANT", F.struct(F.lit("Cuisine").alias("kind"), F.col("brand").alias("value"))),
    )))
    return t.place.select(pairs.alias("pair")).select("pair.kind", "pair.value").distinct()


# -- cluster profiles ---------------------------------------------------------

_ENTROPY = "(SELECT label, -sum(p * ln(p)) AS h, count(*) AS d FROM (SELECT label, n / sum(n) OVER (PARTITION BY label) AS p " \
           "FROM (SELECT label, {c}, count(*) AS n FROM clustered GROUP BY label, {c})) GROUP BY label)"
_MODE = "(SELECT label, {c} AS v FROM (SELECT label, {c}, count(*) AS n FROM clustered GROUP BY label, {c}) " \
        "QUALIFY row_number() OVER (PARTITION BY label ORDER BY n DESC, {c}) = 1)"


@query("cluster_entropy", f"""
    SELECT 'given' AS method, a.label, round(a.h, 6) AS category_entropy, round(b.h, 6) AS sentiment_entropy,
           round(c.h, 6) AS city_entropy
    FROM {_ENTROPY.format(c='primary_category')} a JOIN {_ENTROPY.format(c='sentiment')} b ON a.label = b.label
    JOIN {_ENTROPY.format(c='city')} c ON a.label = c.label""", ("clustered",))
def cluster_entropy(t):
    wide = R.facet_columns(R.cluster_facets(t.clustered), {
        "category_entropy": ("category", "entropy"), "sentiment_entropy": ("sentiment", "entropy"),
        "city_entropy": ("city", "entropy"),
    })
    return wide.select("method", "label", *[
        F.round(c, 6).alias(c) for c in ("category_entropy", "sentiment_entropy", "city_entropy")])


@query("cluster_profile", f"""
    WITH numbers AS (SELECT method, label, count(*) AS size, avg(rating) AS mean_rating, median(rating) AS median_rating,
                            coalesce(stddev_samp(rating), 0.0) AS std_rating,
                            CAST(min(rating) AS DOUBLE) AS min_rating, CAST(max(rating) AS DOUBLE) AS max_rating, avg(weighted_rating) AS weighted_avg,
                            count(DISTINCT city) AS n_city, count(DISTINCT state) AS n_state,
                            count(DISTINCT country) AS n_country, count(DISTINCT place_name) AS n_attraction
                     FROM clustered WHERE label >= 0 GROUP BY method, label)
    SELECT n.method, n.label, size, round(mean_rating, 6) AS mean_rating, median_rating, round(std_rating, 6) AS std_rating,
           min_rating, max_rating, round(weighted_avg, 6) AS weighted_avg, n_city, n_state, n_country, n_attraction,
           a.v AS dominant_category, b.v AS dominant_sentiment, CAST(c.v AS VARCHAR) AS dominant_tier,
           d.v AS top_city, e.v AS top_state, f.v AS top_country
    FROM numbers n JOIN {_MODE.format(c='primary_category')} a ON n.label = a.label
    JOIN {_MODE.format(c='sentiment')} b ON n.label = b.label JOIN {_MODE.format(c='popularity_tier')} c ON n.label = c.label
    JOIN {_MODE.format(c='city')} d ON n.label = d.label JOIN {_MODE.format(c='state')} e ON n.label = e.label
    JOIN {_MODE.format(c='country')} f ON n.label = f.label""", ("clustered",))
def cluster_profile(t):
    profile = R.cluster_profile(t.clustered).drop(
        "category_entropy", "sentiment_entropy", "city_entropy", "n_category", "n_sentiment")
    for column in ("mean_rating", "std_rating", "weighted_avg"):
        profile = profile.withColumn(column, F.round(column, 6))
    return profile


_QUALITY = f"""
    WITH numbers AS (SELECT method, label, count(*) AS size, coalesce(stddev_samp(rating), 0.0) AS s
                     FROM clustered WHERE label >= 0 GROUP BY method, label),
         parts AS (SELECT n.method, n.label, n.size, 1 - a.h AS category_cohesion, 1 - b.h AS sentiment_cohesion,
                          1 / (1 + n.s) AS rating_consistency, c.h AS location_diversity, ln(greatest(2, c.d)) AS top
                   FROM numbers n JOIN {_ENTROPY.format(c='primary_category')} a ON n.label = a.label
                   JOIN {_ENTROPY.format(c='sentiment')} b ON n.label = b.label
                   JOIN {_ENTROPY.format(c='city')} c ON n.label = c.label),
         quality AS (SELECT *, (category_cohesion + sentiment_cohesion + rating_consistency
                                + 1 - location_diversity / top) / 4 AS overall_quality_score FROM parts)"""


@query("cluster_quality", f"""{_QUALITY}
    SELECT method, label, size, round(category_cohesion, 6) AS category_cohesion,
           round(sentiment_cohesion, 6) AS sentiment_cohesion, round(rating_consistency, 6) AS rating_consistency,
           round(location_diversity, 6) AS location_diversity, round(overall_quality_score, 6) AS overall_quality_score
    FROM quality""", ("clustered",))
def cluster_quality(t):
    quality = R.cluster_quality(R.cluster_profile(t.clustered))
    rounded = [F.round(c, 6).alias(c) for c in quality.columns if c not in ("method", "label", "size")]
    return quality.select("method", "label", "size", *rounded)


@query("cluster_summary", f"""{_QUALITY}
    SELECT method, count(*) AS total_clusters, CAST(sum(size) AS BIGINT) AS total_points,
           round(avg(size), 6) AS avg_cluster_size, round(stddev_pop(size), 6) AS std_cluster_size,
           min(size) AS min_cluster_size, max(size) AS max_cluster_size,
           round(avg(overall_quality_score), 6) AS avg_quality_score
    FROM quality GROUP BY method""", ("clustered",))
def cluster_summary(t):
    summary = R.cluster_summary(R.cluster_quality(R.cluster_profile(t.clustered)))
    for column in ("avg_cluster_size", "std_cluster_size", "avg_quality_score"):
        summary = summary.withColumn(column, F.round(column, 6))
    return summary


@query("cluster_labels", "SELECT DISTINCT label FROM embeddings WHERE label >= 0")
def cluster_labels(t):
    return R.without_noise(t.table("embeddings").select("label")).distinct()


@query("dist_json", """
    SELECT label, concat('{', string_agg(concat('"', primary_category, '":', n), ',' ORDER BY primary_category), '}') AS distribution
    FROM (SELECT label, primary_category, count(*) AS n FROM clustered GROUP BY label, primary_category) GROUP BY label""", ("clustered",))
def dist_json(t):
    """Category distribution of each cluster as one JSON text."""
    return R.distribution_json(R.value_counts(R.without_noise(t.clustered), ["label"], "primary_category"), ["label"])
