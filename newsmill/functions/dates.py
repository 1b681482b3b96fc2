"""Date functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.columns import col


def parsed(df: DataFrame, name: str, formats: Sequence[str] = ()) -> Column:
    """The column as a time. Stored times pass untouched; text is tried in the given formats and
    then as ISO text, row by row, and is NULL where none fits."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return col(name)
    raw = col(name).cast("string")
    return F.coalesce(*[F.try_to_timestamp(raw, F.lit(f)) for f in formats], raw.try_cast("timestamp"))


def parts(day: Column, prefix: str = "analysis") -> dict[str, Column]:
    """Year, month, weekday (Monday is 0) and quarter with their English names."""
    return {
        f"{prefix}_year": F.year(day),
        f"{prefix}_month": F.month(day),
        f"{prefix}_month_name": F.date_format(day, "MMMM"),
        f"{prefix}_weekday": F.weekday(day),
        f"{prefix}_weekday_name": F.date_format(day, "EEEE"),
        f"{prefix}_quarter": F.quarter(day),
    }


def decade(year: Column) -> Column:
    label = F.concat((F.floor(year / 10) * 10).cast("bigint").cast("string"), F.lit("s"))
    return F.coalesce(label, F.lit("unknown"))
