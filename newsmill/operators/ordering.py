"""Positions, running totals and keep-first rules that no single task has to carry.

A DataFrame has no row order, so every rule of the form "first" or "every k-th" takes an order key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.columns import col, number_or_zero, require
from newsmill.session import cut

# From so many rows per group Spark has no group limit.
GROUP_LIMIT = 1000


def keep_first(df: DataFrame, keys: Sequence[Column], order: Sequence[Column], n: int = 1, out: str | None = None) -> DataFrame:
    """The first ``n`` rows per key in the given order, with their rank (from 1) if ``out`` names it.

    The rank filter becomes a group limit that runs before the shuffle, so a hot key sends at
    most ``n`` rows per input task. Spark sets that limit only below ``GROUP_LIMIT`` rows; for more, the
    rows of a key are first ranked by the task that they come from, so that the parts of a hot key grow
    in number with the input and no task sorts all of it.
    """
    if n >= GROUP_LIMIT:
        part = Window.partitionBy(*keys, "_nm_task").orderBy(*order)
        df = df.withColumn("_nm_task", F.spark_partition_id()).withColumn("_nm_rank", F.row_number().over(part)).where(F.col("_nm_rank") <= n).drop("_nm_rank", "_nm_task")
    w = Window.partitionBy(*keys).orderBy(*order)
    name = out or "_nm_rank"
    ranked = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return ranked if out else ranked.drop(name)


def top_per_group(
    df: DataFrame, group: str, value: str, key: str, n: int = 3, ascending: bool = False, keep: Sequence[str] | None = None
) -> DataFrame:
    """The ``n`` rows with the largest (or smallest) value per group. NULL values count as 0, rows
    without a group vanish, ``key`` settles ties. The group column is always kept."""
    zeroed = df.where(col(group).isNotNull()).withColumn(value, number_or_zero(df, require(df, value)))
    best = keep_first(zeroed, [col(group)], [col(value).asc() if ascending else col(value).desc(), col(key)], n)
    return best if keep is None else best.select(*[col(c) for c in dict.fromkeys([key, group, value, *keep])])


def prefix_sum(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[Column], value: Column, out: str) -> DataFrame:
    """Adds the sum of ``value`` over all earlier rows of the same key.

    ``bucket`` must never fall as the order rises. A task sorts one bucket of one key, never a
    whole key; the totals of the earlier buckets come from a table with one row per bucket.
    """
    staged = df.withColumns({"_nm_bucket": bucket, "_nm_value": value})
    ks = [col(k) for k in keys]
    totals = staged.groupBy(*ks, "_nm_bucket").agg(F.sum("_nm_value").alias("_nm_total"))
    earlier = Window.partitionBy(*ks).orderBy("_nm_bucket").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    offsets = totals.withColumn("_nm_offset", F.coalesce(F.sum("_nm_total").over(earlier), zero)).drop("_nm_total")
    inside = Window.partitionBy(*ks, "_nm_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        staged.join(offsets, [*keys, "_nm_bucket"])
        .withColumn(out, F.col("_nm_offset") + F.coalesce(F.sum("_nm_value").over(inside), zero))
        .drop("_nm_bucket", "_nm_value", "_nm_offset")
    )


def position(df: DataFrame, order_col: str, out: str = "position", ranges: int | None = None) -> DataFrame:
    """Adds the 0-based position of each row over the whole frame, by a unique key.

    Rows are dealt to ranges of the key, sorted within and stored, so that a row keeps its place however often it is
    read. A position is the number of rows in earlier ranges and the place within its own: no window, and a table
    with one row per range.
    """
    keyed = (ranges, col(order_col)) if ranges else (col(order_col),)
    stored = cut(df.repartitionByRange(*keyed).sortWithinPartitions(col(order_col)))
    # The number of a row holds that of its range above the place within it.
    placed = stored.withColumn("_nm_at", F.monotonically_increasing_id())
    placed = placed.withColumns({"_nm_range": F.shiftright("_nm_at", 33), "_nm_at": F.col("_nm_at").bitwiseAND((1 << 33) - 1)})
    sizes = placed.groupBy("_nm_range").agg(F.count(F.lit(1)).alias("_nm_rows"))
    earlier = Window.orderBy("_nm_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_nm_range", F.coalesce(F.sum("_nm_rows").over(earlier), F.lit(0)).alias("_nm_offset"))
    return placed.join(F.broadcast(offsets), "_nm_range").withColumn(out, F.col("_nm_offset") + F.col("_nm_at")).drop("_nm_range", "_nm_at", "_nm_offset")


def group_position(df: DataFrame, keys: Sequence[str], order_col: str, out: str = "position", width: int = 100_000) -> DataFrame:
    """Adds the 0-based position within each key. The order column is a whole number, unique
    within its key, so a bucket of ``width`` numbers never holds more than ``width`` rows."""
    bucket = F.floor(col(order_col) / width)
    return prefix_sum(df, keys, bucket, [col(order_col)], F.lit(1).cast("bigint"), out)


def every_kth(df: DataFrame, order_col: str, step: int, ranges: int | None = None) -> DataFrame:
    """Rows 0, k, 2k … in the order of ``order_col``."""
    if step <= 0:
        raise ValueError("step must be above zero")
    placed = position(df, order_col, "_nm_position", ranges)
    return placed.where(F.col("_nm_position") % step == 0).drop("_nm_position")
