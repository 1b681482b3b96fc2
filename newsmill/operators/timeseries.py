"""Calendar resampling with present gaps, and rolling means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.columns import col, first_present, number, require
from newsmill.functions import dates
from newsmill.operators.quantiles import medians

# Date columns in order of preference.
DATE_COLUMNS = [
    "published_date_mysql", "published_date", "published_date_mongo", "publishedAt", "fetched_at",
    "extraction_timestamp", "release_date",
]

_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def with_date(df: DataFrame, column: str | None = None, out: str = "analysis_date") -> DataFrame:
    """The best date column as a time; unreadable dates are NULL."""
    name = column or first_present(df, DATE_COLUMNS)
    return df.withColumn(out, dates.parsed(df, name) if name else F.lit(None).cast("timestamp"))


def with_date_parts(df: DataFrame, column: str = "analysis_date") -> DataFrame:
    if column not in df.columns:
        df = with_date(df, out=column)
    return df.withColumns(dates.parts(dates.parsed(df, column)))


def _period_start(day: Column, unit: str) -> Column:
    return F.trunc(day.cast("date"), unit)


def resample(
    df: DataFrame, unit: str, date: str = "analysis_date", value: str = "estimated_value", key: str = "record_id", with_median: bool = False
) -> DataFrame:
    """Count, total and mean per calendar period, labelled by its last day. Periods without rows
    are present with count and total 0. Undated rows are left out, NULL values count as 0."""
    if date not in df.columns:
        df = with_date(df, out=date)
    require(df, value)
    months = _MONTHS[unit]
    valued = df.select(
        _period_start(dates.parsed(df, date), unit).alias("_period"), col(key).alias("_key"), F.coalesce(number(df, value), F.lit(0)).alias("_value")
    ).where("_period IS NOT NULL")
    totals = valued.groupBy("_period").agg(
        F.count("_key").alias("article_count"), F.sum("_value").alias(f"total_{value}"), F.avg("_value").alias(f"avg_{value}")
    )
    if with_median:
        totals = totals.join(medians(valued, ["_value"], ["_period"]).withColumnRenamed("median__value", f"median_{value}"), "_period")
    step = F.expr(f"INTERVAL {months} MONTH")
    spine = valued.agg(F.min("_period").alias("a"), F.max("_period").alias("b")).where("a IS NOT NULL")
    spine = spine.select(F.explode(F.sequence("a", "b", step)).alias("_period"))
    filled = spine.join(totals, "_period", "left").fillna(0, ["article_count", f"total_{value}"])
    label = F.last_day(F.add_months("_period", months - 1)).alias(date)
    return filled.select(label, *[c for c in filled.columns if c != "_period"]).orderBy(date)


def monthly(df: DataFrame, **options) -> DataFrame:
    return resample(df, "month", with_median=True, **options)


def quarterly(df: DataFrame, **options) -> DataFrame:
    return resample(df, "quarter", **options)


def yearly(df: DataFrame, **options) -> DataFrame:
    return resample(df, "year", **options)


def with_rolling_means(series: DataFrame, value: str, date: str = "analysis_date", windows: Sequence[int] = (3, 6, 12), groups: Sequence[str] = ()) -> DataFrame:
    """Trailing means over the last rows of a resampled series: one row per period, so even the
    ungrouped window is as short as the calendar."""
    zeroed = F.coalesce(number(series, value), F.lit(0))
    order = Window.partitionBy(*[col(g) for g in groups]).orderBy(date)
    return series.withColumn(value, zeroed).withColumns(
        {f"rolling_{w}_month_avg": F.avg(col(value)).over(order.rowsBetween(1 - w, 0)) for w in windows}
    )


def sessions(
    df: DataFrame, gap: str, groups: Sequence[str], time: str = "ts", sums: Sequence[str] = (), lows: Sequence[str] = (), highs: Sequence[str] = (),
    bucket_seconds: int = 86_400,
) -> DataFrame:
    """Sessions per group: runs of rows of which none is more than ``gap`` after the one before. One row each, with
    ``session_start``, ``session_end`` (the last row's time plus the gap), ``records``, and ``total_``, ``min_`` and
    ``max_`` columns of the named values. Rows without a time belong to none; NULL groups are groups.

    Rows are merged within time buckets first, so that a group with a large share of the rows is spread over tasks;
    what is merged over a whole group are the sessions of its buckets.
    """
    named = [("total", F.sum, n) for n in sums] + [("min", F.min, n) for n in lows] + [("max", F.max, n) for n in highs]
    stamped = df.where(col(time).isNotNull()).withColumns({"_nm_bucket": F.floor(F.unix_seconds(col(time)) / bucket_seconds), "_nm_session": F.session_window(col(time), gap)})
    keys = [col(g) for g in groups]
    parts = stamped.groupBy(*keys, "_nm_bucket", "_nm_session").agg(
        F.count(F.lit(1)).alias("records"), *[f(number(df, n)).alias(f"{kind}_{n}") for kind, f, n in named]
    )
    parts = parts.select(*keys, F.col("_nm_session.start").alias("_nm_start"), F.col("_nm_session.end").alias("_nm_end"), "records", *[f"{kind}_{n}" for kind, _, n in named])
    order = Window.partitionBy(*keys).orderBy("_nm_start")
    so_far = F.max("_nm_end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = parts.withColumn("_nm_new", (so_far.isNull() | (F.col("_nm_start") > so_far)).cast("int"))
    numbered = begins.withColumn("_nm_session", F.sum("_nm_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy(*keys, "_nm_session").agg(
        F.min("_nm_start").alias("session_start"), F.max("_nm_end").alias("session_end"), F.sum("records").alias("records"),
        *[f(f"{kind}_{n}").alias(f"{kind}_{n}") for kind, f, n in named],
    )
    return merged.drop("_nm_session")
