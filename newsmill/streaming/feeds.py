"""A file feed of events, windowed and keyed results, and an upserting result table.

Results go out in update mode: each micro-batch appends its changed rows under its batch number,
and the reader keeps the newest row per key. A batch that is run again after a failure overwrites
its own folder, so the table is exact. :func:`compacted` folds what has accumulated into a base, so
that readers do not have to read every batch ever written.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.columns import col
from newsmill.session import cut
from newsmill.sources import keyfilter
from newsmill.sources.files import exists, is_file

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def parquet_feed(spark: SparkSession, path: str, schema: T.StructType | None = None, time: str = "ts", files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files as a stream. The event time becomes a TIMESTAMP, which watermarks need; a
    time stored without a zone is read as UTC, whatever the session's zone."""
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # The stream source takes folders and patterns; a single file is named by a pattern.
    source = f"{path[:-1]}[{path[-1]}]" if is_file(spark, path) else path
    stamp = as_utc(time) if isinstance(schema[time].dataType, T.TimestampNTZType) else col(time).cast("timestamp")
    return reader.parquet(source).withColumn(time, stamp)


def as_utc(name: str) -> Column:
    """A time without a zone as a TIMESTAMP, read as UTC."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), col(name)))


def utc_time(stamp: Column) -> Column:
    """A TIMESTAMP as a time without a zone, in UTC."""
    return F.convert_timezone(None, F.lit("UTC"), stamp.cast("timestamp_ntz"))


def window_totals(feed: DataFrame, aggregates: Sequence[Column], every: str, slide: str | None = None, groups: Sequence[str] = (), time: str = "ts", lateness: str = "1 day") -> DataFrame:
    """Tumbling or sliding windows; rows later than ``lateness`` are dropped with the old state."""
    w = F.window(col(time), every, slide) if slide else F.window(col(time), every)
    grouped = feed.withWatermark(time, lateness).groupBy(w.alias("_nm_w"), *[col(g) for g in groups]).agg(*aggregates)
    return grouped.select(F.col("_nm_w.start").alias("window_start"), F.col("_nm_w.end").alias("window_end"), *[c for c in grouped.columns if c != "_nm_w"])


def session_totals(feed: DataFrame, aggregates: Sequence[Column], gap: str, groups: Sequence[str], time: str = "ts", lateness: str = "1 day") -> DataFrame:
    """Sessions per group, merged as rows come in: a late row may join two of them. A session goes out once, when the
    watermark has passed its end (run it in append mode); rows later than ``lateness`` are dropped."""
    grouped = feed.withWatermark(time, lateness).groupBy(F.session_window(col(time), gap).alias("_nm_w"), *[col(g) for g in groups]).agg(*aggregates)
    return grouped.select(*[col(g) for g in groups], F.col("_nm_w.start").alias("session_start"), F.col("_nm_w.end").alias("session_end"), *[c for c in grouped.columns if c not in ("_nm_w", *groups)])


def live_ticks(feed: DataFrame, tick: str = "1 minute", alert: Column | None = None, score: Column | None = None, time: str = "ts") -> DataFrame:
    """Records, alerts and mean score per tick."""
    return window_totals(
        feed,
        [
            F.count(F.lit(1)).alias("records"),
            F.count_if(alert if alert is not None else F.lit(False)).alias("alerts"),
            F.avg(score if score is not None else F.lit(0.0)).alias("score"),
        ],
        tick, time=time,
    )


def thinned(feed: DataFrame, keys: Sequence[str], time: str = "ts") -> DataFrame:
    """Drops copies that meet in one Arrow batch, before any shuffle: of an event delivered over
    and over, each task then sends a few copies instead of all. The copy with the latest time stays, so
    that an event with one copy in time is not lost with a late one."""

    def latest_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch]).append_column("_nm_row", pa.array(np.arange(batch.num_rows)))
            ordered = rows.sort_by([(time, "descending"), ("_nm_row", "ascending")])
            firsts = ordered.group_by(list(keys), use_threads=False).aggregate([("_nm_row", "first")])["_nm_row_first"]
            yield batch if len(firsts) == batch.num_rows else batch.take(firsts.combine_chunks())

    return feed.mapInArrow(latest_copies, feed.schema)


def new_events(feed: DataFrame, keys: Sequence[str], time: str = "ts", lateness: str = "1 day", thin: bool = True) -> DataFrame:
    """Events not seen before; a key is remembered as long as a late copy may still come."""
    source = thinned(feed, keys, time) if thin else feed
    return source.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def running_means(feed: DataFrame, group: str, value: str) -> DataFrame:
    """Sum, count and mean per group, kept up to date batch by batch."""
    return (
        feed.where(col(group).isNotNull() & col(value).isNotNull())
        .groupBy(col(group))
        .agg(F.sum(value).alias("value_sum"), F.count(value).alias("record_count"))
        .withColumn("mean_value", F.col("value_sum") / F.col("record_count"))
    )


def run_available(stream: DataFrame, folder: str, mode: str = "update") -> str:
    """Processes everything the source has now and stops; returns the result path."""
    spark = stream.sparkSession
    result = f"{folder}/result"

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{result}/batch={number}")

    previous = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        query = (
            stream.writeStream.outputMode(mode).foreachBatch(store)
            .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        if previous is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, previous)
    return result


def ingest_new(feed: DataFrame, path: str, keys: Sequence[str], state: str, blocks: int = keyfilter.BLOCKS) -> int:
    """Adds the rows of a stream whose key is not in the table at ``path`` yet, each key once, however long ago it was
    stored; returns the number of batches the table then has.

    A batch goes to its own folder ``batch=N`` and is only compared with earlier ones, so that one that runs again
    after a failure finds what it found before and replaces its own rows. Next to them lie the keys of the batch,
    by hash range, and a filter of them: rows whose key the filter rules out are not joined, and of the stored keys
    only the ranges that a possible hit falls into are read. Rows with a NULL in a key are left out.
    """
    spark = feed.sparkSession

    def store(batch: DataFrame, number: int) -> None:
        rows = cut(batch.where(reduce(and_, [col(k).isNotNull() for k in keys])).dropDuplicates(list(keys)))
        stored = keyfilter.Keys(spark, f"{path}/_keys", list(keys), blocks, before=number)
        new = cut(stored.missing_from(rows))
        new.write.mode("overwrite").parquet(f"{path}/batch={number}")
        stored.add(new, number)

    (
        feed.writeStream.foreachBatch(store).option("checkpointLocation", state)
        .trigger(availableNow=True).start().awaitTermination()
    )
    return 0 if not exists(spark, path) else spark.read.parquet(path).select("batch").distinct().count()


def compacted(spark: SparkSession, result: str, keys: Sequence[str], base: str, earlier: str | None = None) -> int:
    """Writes the newest row per key of all batches so far to ``base`` and returns the last batch in it.

    With ``earlier``, the base made before, only batches after that one are read besides it. ``base`` is a
    new folder; readers move on to it once this returns, and older batches may then be removed.
    """
    rows = _batches(spark, result, earlier)
    last = rows.agg(F.max("batch")).first()[0]
    if last is None:
        raise ValueError("there are no batches yet")
    _newest(rows, keys).withColumn("_nm_until", F.lit(last)).write.mode("errorifexists").parquet(base)
    return last


def _batches(spark: SparkSession, result: str, base: str | None) -> DataFrame:
    """The rows of all batches, or those of a base (under the number of its last batch) and of later ones."""
    rows = spark.read.parquet(result).withColumn("batch", F.col("batch").cast("bigint"))
    if base is None:
        return rows
    old = spark.read.parquet(base).withColumnRenamed("_nm_until", "batch")
    until = old.agg(F.max("batch")).first()[0]
    return old.unionByName(rows.where(F.col("batch") > (-1 if until is None else until)))


def latest(spark: SparkSession, result: str, keys: Sequence[str], base: str | None = None) -> DataFrame:
    """The newest row per key of an upserting result; map-side aggregation keeps one row per key
    and task before the shuffle. With ``base``, a compacted table, only the batches after it are read."""
    return _newest(_batches(spark, result, base), keys)


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    others = [c for c in rows.columns if c not in (*keys, "batch")]
    newest = rows.groupBy(*[col(k) for k in keys]).agg(F.max_by(F.struct(*[col(c) for c in others]), "batch").alias("_nm_row"))
    return newest.select(*[col(k) for k in keys], *[F.col(f"_nm_row.`{c}`").alias(c) for c in others])
