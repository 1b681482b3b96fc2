"""Column profiles of chunks that are kept as sketches and merged without the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.columns import col, number, numeric_columns
from newsmill.columns import text as as_text
from newsmill.sources.files import exists

# Size of the sketches. Distinct counts: 2^14 registers, within 3 % (three deviations of 0.8 %). Quantiles: ranks within
# 1 % of the rows at k = 400.
DISTINCT_BITS, QUANTILE_K = 14, 400
DISTINCT_ERROR, RANK_ERROR = 0.03, 0.01


def add_chunks(df: DataFrame, path: str, chunk: str, names: Sequence[str] | None = None) -> None:
    """Profiles the chunks of ``df`` that the table at ``path`` does not have yet: one row per chunk and column, with the
    number of rows, of values, the total, and the sketches. Rows of stored chunks are not read where ``chunk`` is
    a partition column."""
    spark = df.sparkSession
    names = [n for n in (names or df.columns) if n != chunk]
    if exists(spark, path):
        known = [r[0] for r in spark.read.parquet(path).select("chunk").distinct().collect()]
        df = df.where(~col(chunk).cast("string").isin(known))
    numbers = set(numeric_columns(df))
    empty = F.lit(None)
    wide = []
    for n in names:
        v = number(df, n).cast("double") if n in numbers else empty.cast("double")
        wide.append(
            F.struct(
                F.lit(n).alias("column"), F.count(F.lit(1)).alias("rows"), F.count(as_text(df, n)).alias("values"), F.sum(v).alias("total"), F.min(v).alias("low"), F.max(v).alias("high"),
                F.hll_sketch_agg(F.when(as_text(df, n).isNotNull(), F.xxhash64(as_text(df, n))), DISTINCT_BITS).alias("distinct"),
                (F.kll_sketch_agg_double(v, QUANTILE_K) if n in numbers else empty.cast("binary")).alias("quantiles"),
            )
        )
    found = df.where(col(chunk).isNotNull()).groupBy(col(chunk).cast("string").alias("chunk")).agg(F.array(*wide).alias("columns"))
    found.select("chunk", F.inline("columns")).write.mode("append").parquet(path)


def profile(spark: SparkSession, path: str, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``column``, ``rows``, ``values``, ``mean``, ``low``, ``high``, ``distinct`` and ``q…`` of all chunks together, from the
    sketches alone: exact but for ``distinct`` (within ``DISTINCT_ERROR``) and the quantiles (rank within ``RANK_ERROR``)."""
    rows = spark.read.parquet(path)
    merged = rows.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("values").alias("values"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )
    points = [F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("quantiles", F.lit(q))).alias(f"q{round(q * 100)}") for q in quantiles]
    return merged.select(
        "column", "rows", "values", F.try_divide("total", "values").alias("mean"), "low", "high", F.hll_sketch_estimate("distinct").alias("distinct"), *points
    )
