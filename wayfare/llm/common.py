"""What the operators of this subpackage share: tables, saved steps, Arrow slices, running totals, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.session import scratch_path

#: Rows of one slice handed to a Python function; long texts never pile up beyond it.
SLICE_ROWS = 256
_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    "array<double>": pa.list_(pa.float64()), "array<float>": pa.list_(pa.float32()),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here and lost executors lose nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def arrow_map(
    df: DataFrame, fn: Callable[..., dict[str, Sequence]], schema: dict[str, str], rows: int = SLICE_ROWS,
) -> DataFrame:
    """``fn`` gets each column of ``df`` as a list, a slice of rows at a time, and returns the columns of ``schema``."""
    arrow = pa.schema([(name, _ARROW[kind]) for name, kind in schema.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows):
            out = fn(*(column.to_pylist() for column in part.columns))
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, ", ".join(f"`{name}` {kind}" for name, kind in schema.items()))


def running(df: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """Totals of all rows before each row in a global order, one new column per entry of ``sums``.

    Rows are dealt by ranges of the order; only one row per range meets in a
    single task, so no task ever gets all rows. Rows must not be equal in the
    whole order, or their place among each other is any.
    """
    dealt = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    dealt = saved(dealt.withColumns({f"__v_{k}": v for k, v in sums.items()}), "ranges")
    totals = dealt.groupBy("__part").agg(*(F.sum(f"__v_{k}").alias(f"__t_{k}") for k in sums))
    parts = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        F.col("__part"), *(F.coalesce(F.sum(f"__t_{k}").over(parts), F.lit(0)).alias(f"__b_{k}") for k in sums))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.join(before, "__part")
        .withColumns({k: F.col(f"__b_{k}") + F.coalesce(F.sum(f"__v_{k}").over(inside), F.lit(0)) for k in sums})
        .drop("__part", *(f"__v_{k}" for k in sums), *(f"__b_{k}" for k in sums))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b); root is the smallest node its links reach.

    Alternating star steps: each node hands its neighbours to the smallest of
    them, until only stars are left. Every round is an aggregate and a join
    that Spark can split, and is written out, so a lost executor costs a
    round at most. Nothing but two numbers reaches the driver.
    """
    links = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = saved(links, "links")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").distinct()
        lower = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(lower, "b").select(
            F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a <> b").distinct()
        links = saved(small, "links")
        state = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("b")).first()
        if state[0] == state[2] and state == before:  # one parent each, and a whole round changed nothing
            break
        before = state
    roots = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str], rows: int = 512) -> Iterator[dict[str, list]]:
    """Columns of each run of rows that are equal in ``keys``, of rows sorted by them; a run may go over batches."""
    held: dict[str, list] | None = None
    mark = None
    for part in slices(batches, rows):
        columns = part.to_pydict()
        marks = list(zip(*(columns[k] for k in keys)))
        at = 0
        while at < len(marks):
            end = at
            while end < len(marks) and marks[end] == marks[at]:
                end += 1
            if marks[at] != mark:
                if held is not None:
                    yield held
                held, mark = {name: [] for name in columns}, marks[at]
            for name, values in columns.items():
                held[name] += values[at:end]
            at = end
    if held is not None:
        yield held


def in_blocks(members: DataFrame, bucket: str, size: str, node: str, block: int) -> DataFrame:
    """Members of buckets dealt to pairs of blocks (columns block, left, right), sorted for ``runs``.

    A bucket of ``size`` members has a block for every ``block`` of them, and a
    member goes to each pair its block is in, so a task holds two blocks at most
    and a large bucket is met by many tasks.
    """
    dealt = members.withColumn("parts", F.ceil(F.col(size) / block).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(node, bucket), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.withColumns({"left": F.least("block", "other"), "right": F.greatest("block", "other")})
    return dealt.drop("parts", "other").repartition(bucket, "left", "right").sortWithinPartitions(bucket, "left", "right", node)
