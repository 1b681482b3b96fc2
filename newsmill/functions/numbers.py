"""Number functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(c: Column, places: int = 2) -> Column:
    return F.bround(c.cast("double"), places)


def share(part: Column, whole: Column, places: int = 2) -> Column:
    """Percentage, half-even; zero for an empty whole."""
    return F.coalesce(half_even(F.try_divide(part.cast("double") * 100, whole.cast("double")), places), F.lit(0.0))


def severity(pct: Column) -> Column:
    return F.when(pct > 30, "HIGH").when(pct > 10, "MEDIUM").otherwise("LOW")


def engagement(rating: Column, popularity: Column, length: Column) -> Column:
    return rating * 10 + popularity * 0.05 + length * 0.01


def worth(engagement_score: Column, length: Column) -> Column:
    return engagement_score * (length + 1)


def clip(c: Column, low: float, high: float) -> Column:
    """NULL stays NULL."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))
