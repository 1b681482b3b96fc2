"""A table in key buckets that is upserted in place: only the buckets that new rows fall into are written anew."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.operators.joins import merge_fields, upsert
from newsmill.session import cut

BUCKET = "_nm_bucket"


def _bucket(key: str, count: int) -> Column:
    return F.pmod(F.xxhash64(col(key)), F.lit(count)).cast("int")


def create(df: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Writes ``df`` in ``buckets`` folders by the hash of its key; their number stays with the table."""
    laid = df.withColumn(BUCKET, _bucket(key, buckets)).repartition(BUCKET)
    laid.write.mode("errorifexists").partitionBy(BUCKET).parquet(path)
    df.sparkSession.createDataFrame([(buckets, key)], "buckets int, key string").coalesce(1).write.parquet(f"{path}/_buckets")


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def _replace_touched(new: DataFrame, path: str, merge: Callable[[DataFrame, DataFrame, str], DataFrame]) -> list[int]:
    spark = new.sparkSession
    layout = spark.read.parquet(f"{path}/_buckets").first()
    place = _bucket(layout["key"], layout["buckets"])
    incoming = cut(new.where(col(layout["key"]).isNotNull()))
    touched = sorted(r[0] for r in incoming.select(place.alias("b")).distinct().collect())  # at most one per bucket
    if not touched:
        return []
    old = spark.read.parquet(path).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    # Stored before the write, which replaces the files that it comes from.
    merged = cut(merge(old, incoming, layout["key"]).withColumn(BUCKET, place))
    merged.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return touched


def upsert_into(new: DataFrame, path: str, order: Sequence[str] = ()) -> list[int]:
    """Replaces whole rows by key, as :func:`newsmill.operators.joins.upsert`; returns the buckets written.

    The old rows of these buckets are read, merged and stored, then their folders are replaced at the commit of the
    write; an upsert that runs again gives the same table. Rows without a key are left out. One writer at a time.
    """
    return _replace_touched(new, path, lambda old, rows, key: upsert(old, rows, key, order))


def merge_into(new: DataFrame, path: str, given: str | None = None, order: Sequence[str] = ()) -> list[int]:
    """Replaces single fields by key, as :func:`newsmill.operators.joins.merge_fields`; returns the buckets written."""
    return _replace_touched(new, path, lambda old, rows, key: merge_fields(old, rows, key, given, order))
