"""Key checks and table profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Rows, nulls, distinct values, smallest and largest value of every column.

    Smallest and largest are found in the column's own type, all columns in one
    aggregate, and written as text only then. Exact distinct counts come from
    one pass in which columns open into (column, value) rows and shrink to value
    counts first; otherwise they are estimated in the same aggregate.
    """
    def one(c: str):
        fields = [
            F.lit(c).alias("column_name"), F.count("*").alias("n_rows"), F.count_if(F.col(c).isNull()).alias("n_null"),
            F.min(c).cast("string").alias("min_value"), F.max(c).cast("string").alias("max_value")]
        return F.struct(*fields, *([] if exact else [F.approx_count_distinct(c).alias("n_distinct")]))

    described = df.agg(F.array(*[one(c) for c in df.columns]).alias("p")).select(F.explode("p").alias("p")).select("p.*")
    if exact:
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns])
        values = df.select(F.explode(pairs).alias("p")).select("p.*").distinct()
        distinct = values.groupBy("column_name").agg(F.count_if(F.col("value").isNotNull()).alias("n_distinct"))
        described = described.join(distinct, "column_name", "left").withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))
    return described.select("column_name", "n_rows", "n_null", "n_distinct", "min_value", "max_value")
