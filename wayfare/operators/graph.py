"""Property graph as two tables: nodes(label, id, properties...) and edges(src_label, src, rel, dst_label, dst)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions import casts
from wayfare.operators.reviews import cap_per_group, last_per_key

# Node labels and the properties a pattern query returns.
PLACE_LABELS = {"HOTEL": "Hotel", "ATTRACTION": "Attraction", "RESTAURANT": "Restaurant"}
RETURNED = {
    "Hotel": ("name", "rating", "price", "city"),
    "Restaurant": ("name", "rating", "primary_category", "city"),
    "Attraction": ("name", "rating", "primary_category", "city"),
    "City": ("name", "state"),
    "Category": ("name",),
}
NODE_COLUMNS = {
    "label": "string", "id": "string", "name": "string", "rating": "double",
    "city": "string", "state": "string", "primary_category": "string", "price": "double",
}
EDGE_COLUMNS = ("src_label", "src", "rel", "dst_label", "dst")

# The property list of each place node.
PLACE_PROPERTIES = {
    "Attraction": ("attraction_id", "name", "rating", "review_count", "ranking", "phone", "website", "email",
                   "description", "latitude", "longitude"),
    "Hotel": ("hotel_id", "name", "rating", "review_count", "price_range", "ranking", "phone", "address", "website",
              "email", "hotel_class", "number_of_rooms", "latitude", "longitude"),
    "Restaurant": ("restaurant_id", "name", "rating", "review_count", "price_category", "ranking", "phone", "website",
                   "email", "cuisines", "latitude", "longitude"),
}
# The property list of a review node.
REVIEW_PROPERTIES = ("review_id", "rating", "text", "title", "travel_date", "trip_type", "user_name", "user_id")
WHOLE_NUMBERS = ("review_count", "ranking", "number_of_rooms")
DECIMALS = ("rating", "latitude", "longitude", "hotel_class")


def city_id(city="city", state="state"):
    return F.concat_ws("|", city, state)


def place_label():
    chain = None
    for kind, label in PLACE_LABELS.items():
        test = F.col("type") == kind
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain


def graph_places(place: DataFrame) -> DataFrame:
    return place.filter(F.col("type").isin(*PLACE_LABELS)).withColumn("label", place_label())


def place_nodes(raw: DataFrame, label: str, version: Sequence[str]) -> DataFrame:
    """Node rows of one family from a text table: one row per id (newest version), typed, no nulls."""
    names = PLACE_PROPERTIES[label]
    key = names[0]
    newest = last_per_key(raw.withColumn(key, F.col(key).cast("string")), [key], version)
    columns = []
    for name in names:
        value = F.col(name)
        if name in WHOLE_NUMBERS:
            value = casts.int_or_zero(value)
        elif name in DECIMALS:
            value = casts.double_or_zero(value)
        else:
            value = F.coalesce(value.cast("string"), F.lit(""))
        columns.append(value.alias(name))
    return newest.select(*columns)


def review_nodes(review: DataFrame, version: Sequence[str]) -> DataFrame:
    """Review nodes of a review table: one row per id (newest version); missing texts are '' and ratings 0."""
    newest = last_per_key(review.withColumn("review_id", F.col("review_id").cast("string")), ["review_id"], version)
    return newest.select(*[
        (casts.double_or_zero(F.col(name)) if name in DECIMALS else F.coalesce(F.col(name).cast("string"), F.lit(""))).alias(name)
        for name in REVIEW_PROPERTIES])


def as_nodes(reviews: DataFrame) -> DataFrame:
    """Review nodes in the columns of the node table."""
    return _shape(reviews, F.lit("Review"), id=F.col("review_id"), name=F.col("title"), rating=F.col("rating"))


def _shape(df: DataFrame, label, **columns) -> DataFrame:
    given = {"label": label, **columns}
    return df.select(*[
        (given[name] if name in given else F.lit(None)).cast(kind).alias(name)
        for name, kind in NODE_COLUMNS.items()
    ])


def build_nodes(place: DataFrame) -> DataFrame:
    """Place, city and category nodes of a rated place table."""
    kept = graph_places(place)
    places = _shape(
        kept, F.col("label"), id=F.col("place_id"), name=F.col("name"),
        rating=F.coalesce("rating", F.lit(0.0)), city=F.col("city"), state=F.col("state"),
        primary_category=F.col("primary_category"), price=F.col("price"),
    )
    cities = kept.select("city", "state").distinct()
    cities = _shape(cities, F.lit("City"), id=city_id(), name=F.col("city"), state=F.col("state"))
    categories = kept.filter(F.col("type") == "ATTRACTION").select("primary_category").distinct()
    categories = _shape(categories, F.lit("Category"), id=F.col("primary_category"), name=F.col("primary_category"))
    return places.unionByName(cities).unionByName(categories)


def edges_between(df: DataFrame, src_label, src, rel: str, dst_label, dst) -> DataFrame:
    """Distinct edges, so one pair and relation appears once however often it was seen."""
    return df.select(
        src_label.alias("src_label"), src.alias("src"), F.lit(rel).alias("rel"),
        dst_label.alias("dst_label"), dst.alias("dst"),
    ).distinct()


def build_edges(place: DataFrame) -> DataFrame:
    kept = graph_places(place)
    located = edges_between(kept, F.col("label"), F.col("place_id"), "LOCATED_IN", F.lit("City"), city_id())
    attractions = kept.filter(F.col("type") == "ATTRACTION")
    category = edges_between(
        attractions, F.col("label"), F.col("place_id"), "HAS_CATEGORY", F.lit("Category"), F.col("primary_category")
    )
    return located.unionByName(category)


def conditions(properties: dict[str, list]):
    """Equality on every property that has values; several values mean any of them."""
    tests = [F.col(name).isin(*values) for name, values in properties.items() if values]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _side(nodes: DataFrame, end: dict, key: str) -> DataFrame:
    label = end["type"]
    kept = nodes.filter((F.col("label") == label) & conditions(end.get("properties", {})))
    columns = [F.col("id").alias(key)]
    for prop in RETURNED.get(label, ("id",)):
        columns.append(F.col(prop).alias(f"{label}_{prop}"))
    if key == "src":
        ranked = label in PLACE_LABELS.values()
        columns.append((F.coalesce("rating", F.lit(0.0)) if ranked else F.lit(0.0)).alias("_rank_value"))
    return kept.select(*columns)


def match(nodes: DataFrame, edges: DataFrame, triplet: dict, k: int = 10) -> DataFrame:
    """One-hop pattern (subject)-[relation]->(object), best rated subjects first, ``k`` rows."""
    subject, relation, obj = triplet["subject"], triplet["relation"], triplet["object"]
    hops = edges.filter(
        (F.col("rel") == relation) & (F.col("src_label") == subject["type"]) & (F.col("dst_label") == obj["type"])
    ).select("src", "dst")
    found = hops.join(_side(nodes, obj, "dst"), "dst").join(_side(nodes, subject, "src"), "src")
    returned = [c for c in found.columns if c not in ("src", "dst", "_rank_value")]
    best = found.orderBy(F.col("_rank_value").desc(), "src", "dst").limit(k)
    return best.select(F.lit(relation).alias("relationship_type"), *returned)


def match_all(nodes: DataFrame, edges: DataFrame, triplets: list[dict], k: int = 5) -> DataFrame:
    """Results of several patterns, numbered; a pattern without a match adds no rows."""
    parts = [
        match(nodes, edges, triplet, k).withColumn("query_no", F.lit(number))
        for number, triplet in enumerate(triplets, start=1)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def match_patterns(nodes: DataFrame, edges: DataFrame, patterns: DataFrame, k: int) -> DataFrame:
    """Many one-hop patterns given as a table (src_label, rel, dst_label, dst_name).

    Equal patterns are answered once: the result has ``k`` ranked subjects per
    distinct pattern, to be joined back to whoever asked.
    """
    asked = patterns.select("src_label", "rel", "dst_label", "dst_name").distinct()
    targets = nodes.select(
        F.col("label").alias("dst_label"), F.col("name").alias("dst_name"), F.col("id").alias("dst")
    )
    subjects = nodes.select(F.col("label").alias("src_label"), F.col("id").alias("src"), "name", "rating")
    found = (
        asked.join(targets, ["dst_label", "dst_name"])
        .join(edges, ["src_label", "rel", "dst_label", "dst"])
        .join(subjects, ["src_label", "src"])
    )
    keys = ["src_label", "rel", "dst_label", "dst_name"]
    order = [F.coalesce("rating", F.lit(0.0)).desc(), F.col("src"), F.col("dst")]
    return cap_per_group(found, keys, order, k, rank="place_rank").select(*keys, "src", "name", "rating", "place_rank")


def node_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("label").agg(F.count("*").alias("n"))


def schema_of(edges: DataFrame) -> DataFrame:
    """Which labels are linked by which relation."""
    return edges.groupBy("src_label", "rel", "dst_label").agg(F.count("*").alias("n"))


def invalid_triplets(triplets: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Triplets whose label pair and relation, or whose object value, the graph does not hold."""
    known = edges.select("src_label", "rel", "dst_label").distinct()
    unknown = triplets.join(known, ["src_label", "rel", "dst_label"], "left_anti").withColumn("problem", F.lit("RELATION"))
    values = nodes.select(F.col("label").alias("dst_label"), F.col("name").alias("dst_name")).distinct()
    missing = (
        triplets.join(known, ["src_label", "rel", "dst_label"], "left_semi")
        .filter(F.col("dst_name").isNotNull())
        .join(values, ["dst_label", "dst_name"], "left_anti").withColumn("problem", F.lit("VALUE"))
    )
    return unknown.unionByName(missing)
