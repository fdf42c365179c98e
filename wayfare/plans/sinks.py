"""Write, read back and compare; tolerant loads; upserts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wayfare import schemas
from wayfare.functions import casts
from wayfare.operators import ingest
from wayfare.plans.ingest import MESSY_SPEC, messy_rows, raw_places
from wayfare.registry import query
from wayfare.session import scratch_path
from wayfare.sources import readers, writers

ROW_SPEC = {"review_id": "string", "place_id": "string", "rating": "int", "published": "date", "trip_type": "string", "spend": "double"}
_ROWS = "SELECT review_id, place_id, rating, published, trip_type, spend FROM review"


def rows(t):
    return t.review.select(*ROW_SPEC)


@query("sink_csv_roundtrip", _ROWS, ("review",))
def sink_csv_roundtrip(t):
    path = scratch_path(t.spark, "csv")
    writers.write_delimited(t.review, path, list(ROW_SPEC))
    return casts.typed(readers.read_delimited(t.spark, path, list(ROW_SPEC), multi_line=False), ROW_SPEC)


@query("sink_partitioned", "SELECT place_id, name, price, city AS location_name FROM place", ("place",))
def sink_partitioned(t):
    """One folder per location. Rebalancing brings a location's rows together but splits a hot location."""
    path = scratch_path(t.spark, "by-location")
    out = t.place.select("place_id", "name", "price", F.col("city").alias("location_name"))
    writers.write_delimited(out.hint("rebalance", "location_name"), path, partition_by=["location_name"])
    stored = t.spark.read.schema("place_id string, name string, price double, location_name string").option("header", True).csv(path)
    return stored.select("place_id", "name", "price", "location_name")


@query("sink_append", _ROWS, ("review",))
def sink_append(t):
    """Two batches, the second appended to the first; a missing rating is in the second."""
    path = scratch_path(t.spark, "append")
    low = F.coalesce(F.col("rating") <= 2, F.lit(False))
    batches = [rows(t).filter(low), rows(t).filter(~low)]
    writers.append_batches(batches, path)
    return casts.typed(readers.read_delimited(t.spark, path, list(ROW_SPEC), multi_line=False), ROW_SPEC)


@query("sink_jsonl_by_category", """
    SELECT place_id AS id, name, CASE type WHEN 'HOTEL' THEN 'hotels' WHEN 'ATTRACTION' THEN 'attractions' ELSE 'restaurants' END AS category
    FROM place WHERE type <> 'VACATION_RENTAL'""", ("place",))
def sink_jsonl_by_category(t):
    """One JSON-lines folder per family, written in one pass; a family without rows gets no folder."""
    path = scratch_path(t.spark, "by-category")
    writers.write_json(ingest.tagged_places(raw_places(t)), path, partition_by=["category"])
    return t.spark.read.schema("id string, name string, category string").json(path)


@query("sink_dual_export", f"SELECT 'csv' AS kind, * FROM ({_ROWS}) UNION ALL SELECT 'json', * FROM ({_ROWS})", ("review",))
def sink_dual_export(t):
    csv_path, json_path = scratch_path(t.spark, "export-csv"), scratch_path(t.spark, "export-json")
    writers.export_both(rows(t), csv_path, json_path)
    csv = casts.typed(readers.read_delimited(t.spark, csv_path, list(ROW_SPEC), multi_line=False), ROW_SPEC)
    json = readers.read_json_typed(t.spark, json_path, ROW_SPEC)
    return csv.withColumn("kind", F.lit("csv")).unionByName(json.withColumn("kind", F.lit("json")))


@query("sink_table_append", """
    SELECT review_id AS "ID", place_id AS "LOCATIONID", rating AS "RATING", trip_type AS "TRIP_TYPE", published AS "PUBLISHEDDATE" FROM review""",
       ("review",))
def sink_table_append(t):
    """Create the table if it is missing, then append twice; the names are upper-cased on the way."""
    name = f"synthetic_reviews_{uuid.uuid4().hex[:12]}"
    writers.create_table(t.spark, "synthetic_reviews", name, scratch_path(t.spark, name))
    values = {"id": "review_id", "locationid": "place_id", "rating": "rating", "trip_type": "trip_type", "publisheddate": "published"}
    kinds = schemas.contract_schema("synthetic_reviews")
    shaped = t.review.select(*[
        (F.col(values[f.name.lower()]) if f.name.lower() in values else F.lit(None)).cast(f.dataType).alias(f.name.lower())
        for f in kinds], F.col("trip_type").alias("part"))
    for chosen in (F.col("part") == "A", F.col("part") != "A"):
        writers.create_table(t.spark, "synthetic_reviews", name)
        writers.append_table(shaped.filter(chosen).drop("part"), name)
    return t.spark.table(name).select("ID", "LOCATIONID", "RATING", "TRIP_TYPE", "PUBLISHEDDATE")


@query("insert_select", """
    SELECT CAST(c_custkey AS INTEGER) AS flight_id, c_nationkey AS source_city_id, c_name AS flight_number FROM customer""")
def insert_select(t):
    name = f"flight_stage_{uuid.uuid4().hex[:12]}"
    writers.create_table(t.spark, "flight_stage_table", name, scratch_path(t.spark, name))
    t.table("customer").createOrReplaceTempView("flight_source")
    t.spark.sql(f"""
        INSERT INTO {name} (flight_id, source_city_id, destination_city_id, airline, flight_number, flight_duration, other_attributes)
        SELECT c_custkey, c_nationkey, NULL, c_mktsegment, c_name, 90, NULL FROM flight_source""")
    return t.spark.table(name).select("flight_id", "source_city_id", "flight_number")


@query("load_with_rejects", """
    SELECT review_id, CASE WHEN line_no <= 3 THEN NULL ELSE place_id END AS place_id, rating, published,
           concat('said "a, b"', chr(10), 'and ', trip_type) AS text, spend FROM review WHERE line_no NOT IN (4, 5)""", ("review",))
def load_with_rejects(t):
    source, target = scratch_path(t.spark, "load"), scratch_path(t.spark, "loaded")
    writers.write_delimited(messy_rows(t), source)
    writers.load_table(readers.read_delimited(t.spark, source, list(MESSY_SPEC), keep_broken=True), MESSY_SPEC, target)
    return writers.loaded_rows(t.spark, target, MESSY_SPEC)


@query("load_rejects", """
    SELECT CASE line_no WHEN 4 THEN 'rating' WHEN 5 THEN 'published' ELSE '' END AS rejected, count(*) AS n FROM review GROUP BY 1""", ("review",))
def load_rejects(t):
    raw = messy_rows(t).select("review_id", *[casts.null_if_marker(F.col(c)).alias(c) for c in MESSY_SPEC if c != "review_id"])
    checked = writers.split_rejects(raw, MESSY_SPEC)
    return checked.groupBy(F.array_join("_rejected", ",").alias("rejected")).agg(F.count("*").alias("n"))


@query("vector_upsert", """
    SELECT vec_id, CASE WHEN label < 4 THEN 2 ELSE 1 END AS load_no, 'reviews' AS namespace,
           round(list_sum(CAST(embedding AS DOUBLE[])) * CASE WHEN label < 4 THEN 2 ELSE 1 END, 4) AS total FROM embeddings""")
def vector_upsert(t):
    """A second load replaces the vectors of four labels; the stored table is written anew."""
    path = scratch_path(t.spark, "vectors")
    first = t.table("embeddings").select(
        F.lit("reviews").alias("namespace"), "vec_id", F.col("embedding").cast("array<double>").alias("vector"), F.lit(1).alias("load_no"), "label")
    second = first.filter(F.col("label") < 4).withColumn("load_no", F.lit(2)).withColumn("vector", F.transform("vector", lambda x: x * 2))
    writers.replace_table(writers.upsert(first, second, ["namespace", "vec_id"], "load_no"), path, partition_by=["namespace"])
    stored = t.spark.read.parquet(path)
    return stored.select("vec_id", "load_no", "namespace", F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query("sink_overwrite", "SELECT label, count(*) AS n FROM node GROUP BY label", ("node",))
def sink_overwrite(t):
    """Derived node table refreshed as a whole, one folder per label."""
    path = scratch_path(t.spark, "nodes")
    for _ in range(2):
        writers.replace_table(t.node, path, partition_by=["label"])
    return t.spark.read.parquet(path).groupBy("label").agg(F.count("*").alias("n"))
