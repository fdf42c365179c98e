"""Casts that never raise, null markers and defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts a loaded file uses for "no value".
NULL_MARKERS = ("NULL", "null", "")


def null_if_marker(value: Column, markers=NULL_MARKERS) -> Column:
    return F.when(~value.isin(*markers), value)


def to_double(value: Column) -> Column:
    return value.try_cast("double")


def to_int(value: Column) -> Column:
    """'1.5' reads as 1: through double, then cut towards zero."""
    return value.try_cast("double").try_cast("int")


def to_long(value: Column) -> Column:
    return value.try_cast("double").try_cast("long")


def double_or_zero(value: Column) -> Column:
    return F.coalesce(to_double(value), F.lit(0.0))


def int_or_zero(value: Column) -> Column:
    return F.coalesce(to_int(value), F.lit(0))


def day(value: Column) -> Column:
    return F.try_to_date(value, "yyyy-MM-dd")


def month_start(value: Column) -> Column:
    """'2024-03' reads as 2024-03-01; a value with a day does not fit and gives null."""
    return F.try_to_date(value, "yyyy-MM")


CASTS = {"string": lambda c: c, "double": to_double, "int": to_int, "long": to_long, "date": day, "month": month_start}


def typed(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Project text columns to the types named in ``spec`` (see CASTS)."""
    return df.select(*[CASTS[kind](F.col(name)).alias(name) for name, kind in spec.items()])


def rename_case(df: DataFrame, upper: bool = False) -> DataFrame:
    return df.toDF(*[c.upper() if upper else c.lower() for c in df.columns])
