"""Readers for nested documents, delimited text and tables. No schema is ever inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare import schemas
from wayfare.functions import casts


# Holds the text of a row whose number of fields is wrong, or that is no JSON of the expected shape.
BROKEN = "_broken"


def read_json(spark: SparkSession, path: str, schema: T.StructType, keep_broken: bool = False) -> DataFrame:
    """One JSON object per line; ``keep_broken`` adds a column with the text of lines that do not parse, for a load to reject."""
    if not keep_broken:
        return spark.read.schema(schema).json(path)
    kept = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    return spark.read.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN).json(path)


def read_reviews(spark: SparkSession, path: str, keep_broken: bool = False) -> DataFrame:
    """Nested review documents, one JSON object per line."""
    return read_json(spark, path, schemas.REVIEW_RAW, keep_broken)


def read_places(spark: SparkSession, path: str, keep_broken: bool = False) -> DataFrame:
    return read_json(spark, path, schemas.PLACE_RAW, keep_broken)


def read_envelope(spark: SparkSession, path: str, row: T.StructType, multi_line: bool = False) -> DataFrame:
    """Rows in the ``data`` list of a document.

    ``multi_line`` reads one document per file; otherwise there is one per line
    and a file can be split between tasks.
    """
    document = T.StructType([T.StructField("data", T.ArrayType(row))])
    pages = spark.read.schema(document).option("multiLine", multi_line).json(path)
    return pages.select(F.explode("data").alias("v")).select("v.*")


def read_json_texts(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """JSON lines with every wanted field read as text, to be cast by rule afterwards."""
    return spark.read.schema(schemas.texts(columns)).json(path)


def read_json_typed(spark: SparkSession, path: str, spec: dict[str, str]) -> DataFrame:
    return casts.typed(read_json_texts(spark, path, list(spec)), spec)


def read_delimited(
    spark: SparkSession, path: str, columns: Sequence[str], header: bool = True, multi_line: bool = True, keep_broken: bool = False
) -> DataFrame:
    """Delimited text as text columns; the markers for "no value" become null.

    Quoted line breaks need ``multi_line``, which reads a file in one piece, so
    writers bound the rows per file. Without line breaks inside quotes turn it
    off. ``keep_broken`` adds a column with the text of rows that have too few
    or too many fields, for a load to reject.
    """
    names = [*columns, BROKEN] if keep_broken else list(columns)
    reader = (
        spark.read.schema(schemas.texts(names))
        .option("header", header).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line).option("mode", "PERMISSIVE").option("enforceSchema", True)
    )
    if keep_broken:
        reader = reader.option("columnNameOfCorruptRecord", BROKEN)
    raw = reader.csv(path)
    return raw.select(*[casts.null_if_marker(F.col(c)).alias(c) for c in columns], *names[len(columns):])


def read_positional(spark: SparkSession, path: str, spec: dict[str, str], multi_line: bool = True) -> DataFrame:
    """Headerless text: the n-th field gets the n-th name and type."""
    return casts.typed(read_delimited(spark, path, list(spec), header=False, multi_line=multi_line), spec)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table
