"""Writers: delimited text, JSON lines, tables, upserts and tolerant loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare import schemas
from wayfare.functions import casts
from wayfare.operators.reviews import last_per_key
from wayfare.sources.readers import BROKEN

# A text file with quoted line breaks is read in one piece, so files stay this small.
ROWS_PER_TEXT_FILE = 500_000  # a packed file of JSON lines as well
GOOD, REJECTED = "good", "rejected"


def write_delimited(df: DataFrame, path: str, columns: Sequence[str] | None = None, header: bool = True,
                    mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    kept = df.select(*columns) if columns else df
    writer = (
        kept.write.mode(mode).option("header", header).option("quote", '"').option("escape", '"')
        .option("maxRecordsPerFile", ROWS_PER_TEXT_FILE)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (), packed: bool = False) -> None:
    """JSON lines; ``packed``: compressed, in files of bounded size, as such a file is read in one piece."""
    writer = df.write.mode(mode)
    if packed:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_TEXT_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def append_batches(batches: Sequence[DataFrame], path: str) -> None:
    """The first batch replaces the output, the others add to it."""
    for number, batch in enumerate(batches):
        write_delimited(batch, path, mode="overwrite" if number == 0 else "append")


def export_both(df: DataFrame, csv_path: str, json_path: str) -> None:
    """The same rows as CSV and as JSON records; ``df`` is computed once."""
    kept = df.persist()
    try:
        write_delimited(kept, csv_path)
        write_json(kept, json_path)
    finally:
        kept.unpersist()


def create_table(spark: SparkSession, table: str, name: str | None = None, path: str | None = None) -> str:
    """Create a contract table unless it exists; returns its name."""
    name = name or table
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schemas.contract_schema(table).toDDL()}) USING parquet{location}")
    return name


def with_audit(df: DataFrame) -> DataFrame:
    """Creation and change time of the rows about to be written."""
    now = F.current_timestamp()
    return df.withColumn("created_at", now).withColumn("updated_at", now)


def append_table(df: DataFrame, name: str) -> None:
    """Append by position after upper-casing the names."""
    casts.rename_case(df, upper=True).write.insertInto(name)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh of a derived table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def split_rejects(raw: DataFrame, spec: dict[str, str], broken: str = "field count") -> DataFrame:
    """Cast text columns by ``spec``; ``_rejected`` lists the columns whose text does not fit its type,
    or says ``broken`` where the reader kept the text of a row it could not take apart (then also in ``_raw``)."""
    cast = {name: casts.CASTS[kind](F.col(name)) for name, kind in spec.items()}
    faults = [
        F.when(F.col(name).isNotNull() & cast[name].isNull(), F.lit(name))
        for name, kind in spec.items() if kind != "string"
    ]
    if BROKEN in raw.columns:
        faults.append(F.when(F.col(BROKEN).isNotNull(), F.lit(broken)))
    bad = F.array_compact(F.array(*faults))
    return raw.select(*[value.alias(name) for name, value in cast.items()], bad.alias("_rejected"),
                      F.struct(*spec, *[c for c in raw.columns if c == BROKEN]).alias("_raw"))


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("_rejected") == 0).drop("_rejected", "_raw")


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("_rejected") > 0).select("_raw.*", "_rejected")


def load_table(raw: DataFrame, spec: dict[str, str], path: str, mode: str = "append", broken: str = "field count") -> None:
    """Tolerant bulk load in one pass over the source.

    Rows that fit their types and rows that do not land in two folders of one
    table; a rejected row keeps its text and the names of the columns at fault.
    """
    checked = split_rejects(raw, spec, broken)
    status = F.when(F.size("_rejected") > 0, REJECTED).otherwise(GOOD)
    kept_text = F.when(F.size("_rejected") > 0, F.col("_raw"))
    checked.withColumn("_raw", kept_text).withColumn("load_status", status).write.mode(mode).partitionBy("load_status").parquet(path)


def loaded_rows(spark: SparkSession, path: str, spec: dict[str, str]) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("load_status") == GOOD).select(*spec)


def loaded_rejects(spark: SparkSession, path: str) -> DataFrame:
    return rejected_rows(spark.read.parquet(path).filter(F.col("load_status") == REJECTED))


def upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Stored and incoming rows together, the highest version of each key kept.

    Write the result to a new path (or partition) before dropping the old one:
    a Parquet folder cannot be replaced while it is being read.
    """
    rest = [c for c in stored.columns if c not in keys and c != version]
    return last_per_key(stored.unionByName(incoming), keys, [version, *rest])
