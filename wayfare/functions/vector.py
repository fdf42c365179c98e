"""Vector expressions over arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Zero where one of the vectors has no length."""
    length = norm(a) * norm(b)
    return F.when(length == 0, F.lit(0.0)).otherwise(F.try_divide(dot(a, b), length))


def parse_vector(text: Column) -> Column:
    """JSON text to array<double>; null if it is not a list of numbers."""
    return F.from_json(F.regexp_replace(text, r"\s", ""), "array<double>")


def vector_status(text: Column, vector: Column, dim: int) -> Column:
    return (
        F.when(text.isNull(), "MISSING")
        .when(vector.isNull() | F.exists(vector, lambda x: x.isNull()), "NOT_NUMERIC")
        .when(F.size(vector) != dim, "WRONG_DIMENSION")
        .otherwise("OK")
    )
