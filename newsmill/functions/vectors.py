"""Measures between two array columns, summed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Zero where either vector has no length."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(F.try_divide(dot(a, b), size))


def euclidean(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))
