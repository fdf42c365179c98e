"""Travel views over the driver tables.

The given tables hold no travel data; these views map them onto places,
reviews, review vectors and requests. ``travel_sql.py`` states the same
views as SQL. Every view covers its whole tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions import rules
from wayfare.operators.graph import build_edges, build_nodes
from wayfare.operators.reviews import place_statistics

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def place_type(size):
    kind = size % 4
    return (
        F.when(kind == 0, "HOTEL").when(kind == 1, "ATTRACTION")
        .when(kind == 2, "RESTAURANT").otherwise("VACATION_RENTAL")
    )


class Travel:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """The table over at least as many tasks as there are cores.

        A small file in one row group reads as one task; for work that is heavy
        per row it is dealt out first. A large table has more tasks than cores
        and stays as it is.
        """
        table = self.table(name)
        cores = self.spark.sparkContext.defaultParallelism
        return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table

    @cached_property
    def cities(self) -> DataFrame:
        nation = self.table("nation")
        region = self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            "n_nationkey",
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.when(F.col("r_regionkey") < 3, "EAST").otherwise("WEST").alias("country"),
        )

    @cached_property
    def place(self) -> DataFrame:
        part = self.table("part").withColumn("n_nationkey", (F.col("p_partkey") % 25).cast("int"))
        return part.join(self.cities, "n_nationkey").select(
            F.col("p_partkey").alias("place_no"),
            F.col("p_partkey").cast("string").alias("place_id"),
            F.col("p_name").alias("name"),
            place_type(F.col("p_size")).alias("type"),
            F.col("p_type").alias("primary_category"),
            F.col("p_brand").alias("brand"),
            F.col("p_size").alias("size_no"),
            F.col("p_retailprice").alias("price"),
            "city", "state", "country",
        )

    @cached_property
    def review(self) -> DataFrame:
        return self.review_of(self.table("lineitem"))

    @cached_property
    def review_spread(self) -> DataFrame:
        """The reviews dealt out for work that is heavy per row."""
        return self.review_of(self.spread("lineitem"))

    @staticmethod
    def review_of(lines: DataFrame) -> DataFrame:
        return lines.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"),
            F.col("l_orderkey").alias("order_no"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").cast("string").alias("place_id"),
            F.col("l_suppkey").cast("string").alias("user_id"),
            (1 + F.floor((F.col("l_quantity") - 1) / 10)).cast("int").alias("rating"),
            F.col("l_shipdate").cast("date").alias("published"),
            F.col("l_returnflag").alias("trip_type"),
            F.col("l_linestatus").alias("status"),
            F.col("l_extendedprice").alias("spend"),
        )

    @cached_property
    def place_stats(self) -> DataFrame:
        return place_statistics(self.review)

    @cached_property
    def review_vector(self) -> DataFrame:
        vectors = self.table("embeddings")
        documents = self.table("documents")
        return vectors.join(documents, vectors.vec_id == documents.doc_id).select(
            "vec_id",
            F.col("vec_id").cast("string").alias("review_id"),
            F.expr("vec_id div 4").cast("string").alias("place_id"),
            F.col("embedding").cast("array<double>").alias("vector"),
            "label", "lang", "source",
            (1 + F.col("n_chars") % 5).cast("int").alias("rating"),
            "text",
        )

    @cached_property
    def clustered(self) -> DataFrame:
        """Review vectors with place columns and the given label as a clustering."""
        place = self.place.withColumnRenamed("name", "place_name").select(
            "place_id", "place_name", "primary_category", "city", "state", "country"
        )
        stats = self.place_stats.select("place_id", "weighted_rating", "rating_tier", "popularity_tier")
        return (
            self.review_vector.drop("text")
            .withColumn("method", F.lit("given"))
            .withColumn("sentiment", rules.sentiment(F.col("rating")))
            .join(place, "place_id").join(stats, "place_id")
        )

    @cached_property
    def request(self) -> DataFrame:
        """One free-text travel request per order; some leave out a place, date or budget."""
        days = (2 + F.col("o_orderkey") % 9)
        start = F.col("o_orderdate").cast("date")

        def part(test, *pieces):
            return F.when(test, F.concat(*pieces)).otherwise("")

        taste = (
            F.when(F.col("c_mktsegment") == "AUTOMOBILE", ", we like the Beach")
            .when(F.col("c_mktsegment") == "BUILDING", ", vegan food please")
            .when(F.col("c_mktsegment") == "FURNITURE", ", travelling alone")
            .when(F.col("c_mktsegment") == "HOUSEHOLD", ", love italien and mountain")
            .otherwise("")
        )
        text = F.concat(
            F.lit("I plan a trip"),
            part(F.col("c_mktsegment") != "MACHINERY", F.lit(" to "), F.col("n_name")),
            part(F.col("o_orderpriority") != "5-LOW", F.lit(" for "), days.cast("string"), F.lit(" days")),
            part(F.col("o_orderstatus") != "P", F.lit(" from "), F.date_format(start, "yyyy-MM-dd")),
            part(F.col("o_custkey") % 3 == 0, F.lit(" until "),
                 F.date_format(F.date_add(start, days.cast("int")), "yyyy-MM-dd")),
            part(F.col("o_orderkey") % 7 != 0, F.lit(" with $"), F.floor(F.col("o_totalprice") / 1000).cast("string")),
            taste,
        )
        orders = self.spread("orders")
        customer = self.table("customer")
        nation = self.table("nation")
        return (
            orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(nation, customer.c_nationkey == nation.n_nationkey)
            .select(F.col("o_orderkey").alias("request_id"), text.alias("text"))
        )

    @cached_property
    def trip(self) -> DataFrame:
        """One trip per order: the customer's city, the order date as start, two to ten days."""
        orders = self.spread("orders")
        customer = self.table("customer")
        start = F.col("o_orderdate").cast("date")
        days = (2 + F.col("o_orderkey") % 9).cast("int")
        return (
            orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(self.cities, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("o_orderkey").alias("request_id"), "city", start.alias("start_date"),
                    F.date_add(start, days).alias("end_date"), days.alias("n_days"))
        )

    @cached_property
    def node(self) -> DataFrame:
        rated = self.place.join(self.place_stats.select("place_id", F.col("mean_rating").alias("rating")), "place_id", "left")
        return build_nodes(rated)

    @cached_property
    def edge(self) -> DataFrame:
        return build_edges(self.place)
