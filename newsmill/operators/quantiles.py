"""Exact quantiles with linear interpolation.

The built-in exact percentile keeps every distinct value of a group in one task's memory. Here the
values are counted per ordered range, and a range that holds a wanted rank is cut into smaller ones
until it has few rows or a single value. Only then its values are sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.columns import col, number, tall
from newsmill.session import BROADCAST_BYTES, cut, size_of

# Value ranges per unit of log1p at first: a range spans 0.02 % of its value, or 0.00024 near zero.
RESOLUTION = 4096
# A range of more rows is cut into so many of equal width, unless all its values are the same.
RANGE_ROWS = 50_000
PARTS = 1024


def value_range(value: Column) -> Column:
    """A whole number that never falls as ``value`` rises (``log1p`` is monotone)."""
    size = F.when(F.abs(value) == float("inf"), F.lit(10_000_000)).otherwise(F.floor(F.log1p(F.abs(value)) * RESOLUTION))
    return (F.signum(value) * size).cast("bigint")


def _rank(p: float, total: Column) -> Column:
    return F.lit(float(p)) * (total - 1)


def long_values(df: DataFrame, values: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """One row per value that is neither NULL nor NaN: the groups, ``column`` and ``value`` (double)."""
    entries = [(v, number(df, v)) for v in values]
    return tall(df, groups, entries, "column", "value", "double").where(F.col("value").isNotNull())


def exact_quantiles(df: DataFrame, values: Sequence[str], probs: Mapping[str, float], groups: Sequence[str] = ()) -> DataFrame:
    """One row per group and value column: the groups, ``column``, ``n`` and one column per
    entry of ``probs``. NULL values do not count, and NULL groups give no row.

    The values are stored once, without the other columns, and hardly shuffled: each pass counts them per range
    (map-side) and goes on with the ranges that hold a wanted rank, until each has at most ``RANGE_ROWS`` rows or
    one value. A last pass sorts the values of those. Only the small table of ranges steers the passes.
    """
    keys = [*groups, "column"]
    ks = [col(k) for k in keys]
    source = df.where(" AND ".join(f"`{g}` IS NOT NULL" for g in groups)) if groups else df
    ranged = cut(long_values(source, values, groups)).withColumn("_nm_b", value_range(F.col("value")))

    def holds(rank: Column, before: Column, after: Column) -> Column:
        return (rank >= before) & (rank < after)

    def wanted(ranges: DataFrame) -> DataFrame:
        """The ranges with a wanted rank, stored: their limits, rows, and rows before them."""
        hit = F.lit(False)
        for p in probs.values():
            for edge in (F.floor, F.ceil):
                hit = hit | holds(edge(_rank(p, F.col("n"))), F.col("_nm_before"), F.col("_nm_before") + F.col("_nm_c"))
        return cut(ranges.where(hit).select(*ks, "_nm_b", "_nm_lo", "_nm_hi", "_nm_c", "_nm_before", "n"))

    counted = [F.count(F.lit(1)).alias("_nm_c"), F.min("value").alias("_nm_lo"), F.max("value").alias("_nm_hi")]
    per_group = Window.partitionBy(*ks)
    up_to = per_group.orderBy("_nm_b").rowsBetween(Window.unboundedPreceding, 0)
    first = ranged.groupBy(*ks, "_nm_b").agg(*counted)
    ranges = wanted(first.withColumns({"n": F.sum("_nm_c").over(per_group), "_nm_before": F.sum("_nm_c").over(up_to) - F.col("_nm_c")}))

    def within(found: DataFrame, small: bool) -> DataFrame:
        """The values inside the stored ranges."""
        limits = found.select(*ks, "_nm_b", F.col("_nm_lo").alias("_nm_from"), F.col("_nm_hi").alias("_nm_to"), "_nm_before", "n")
        limits = F.broadcast(limits) if small else limits
        return ranged.join(limits, [*keys, "_nm_b"]).where(F.col("value").between(F.col("_nm_from"), F.col("_nm_to")))

    crowded = (F.col("_nm_c") > RANGE_ROWS) & (F.col("_nm_lo") < F.col("_nm_hi"))
    while True:
        some, size = ranges.agg(F.count_if(crowded), size_of(ranges)).first()
        small = size <= BROADCAST_BYTES
        if not some:
            break
        share = (F.col("value") - F.col("_nm_from")) / (F.col("_nm_to") - F.col("_nm_from"))
        part = F.least(F.floor(share * PARTS), F.lit(PARTS - 1)).alias("_nm_part")
        parts = within(ranges.where(crowded), small).groupBy(*ks, "_nm_b", "_nm_from", "_nm_before", "n", part).agg(*counted)
        below = Window.partitionBy(*ks, "_nm_b", "_nm_from").orderBy("_nm_part").rowsBetween(Window.unboundedPreceding, 0)
        finer = wanted(parts.withColumn("_nm_before", F.col("_nm_before") + F.sum("_nm_c").over(below) - F.col("_nm_c")))
        ranges = cut(ranges.where(~crowded).unionByName(finer))

    in_range = Window.partitionBy(*ks, "_nm_b", "_nm_from").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        within(ranges, small)
        .groupBy(*ks, "_nm_b", "_nm_from", "_nm_before", "n", "value")
        .agg(F.count(F.lit(1)).alias("_nm_c"))
        .withColumn("_nm_after", F.col("_nm_before") + F.sum("_nm_c").over(in_range))
    )

    before, after = F.col("_nm_after") - F.col("_nm_c"), F.col("_nm_after")

    def at(edge, p: float) -> Column:
        return F.max(F.when(holds(edge(_rank(p, F.col("n"))), before, after), F.col("value")))

    edges = [F.max("n").alias("n")]
    for name, p in probs.items():
        edges += [at(F.floor, p).alias(f"_nm_lo_{name}"), at(F.ceil, p).alias(f"_nm_hi_{name}")]
    found = ranked.groupBy(*ks).agg(*edges)

    def between(name: str, p: float) -> Column:
        low, high, rank = F.col(f"_nm_lo_{name}"), F.col(f"_nm_hi_{name}"), _rank(p, F.col("n"))
        return low + (high - low) * (rank - F.floor(rank))

    return found.select(*ks, "n", *[between(name, p).alias(name) for name, p in probs.items()])


def medians(df: DataFrame, values: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """One row per group with a ``median_<column>`` for each value column."""
    found = exact_quantiles(df, values, {"median": 0.5}, groups)
    picked = [F.max(F.when(F.col("column") == v, F.col("median"))).alias(f"median_{v}") for v in values]
    return found.groupBy(*[col(g) for g in groups]).agg(*picked) if groups else found.agg(*picked)
