import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsmill.streaming import feeds


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


@pytest.fixture
def feed_path(spark, tmp_path):
    """Three deliveries, one file each, with copies of earlier events."""
    days = [
        [(1, at(1), "a", 1.0), (2, at(1, 5), "b", 2.0), (1, at(1), "a", 1.0)],
        [(3, at(2), "a", 3.0), (2, at(1, 5), "b", 2.0)],
        [(4, at(3), "a", 5.0), (5, at(3), "b", None), (3, at(2), "a", 3.0)],
    ]
    path = str(tmp_path / "feed")
    for rows in days:
        spark.createDataFrame(rows, "event_id long, ts timestamp, kind string, value double").coalesce(1).write.mode("append").parquet(path)
    return path


def feed(spark, path):
    return feeds.parquet_feed(spark, path, files_per_trigger=1)


def test_copies_are_dropped_across_deliveries(spark, feed_path, tmp_path):
    result = feeds.run_available(feeds.new_events(feed(spark, feed_path), ["event_id"], lateness="5 days"), str(tmp_path / "out"), "append")
    assert sorted(r["event_id"] for r in spark.read.parquet(result).collect()) == [1, 2, 3, 4, 5]


def test_thinning_keeps_one_copy_of_each(spark):
    rows = [(i % 7, at(1), "x" * (i % 7)) for i in range(500)] + [(None, at(2), "n"), (None, at(2), "n")]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, kind string").coalesce(1)
    assert sorted(tuple(r) for r in feeds.thinned(df, ["event_id"]).collect() if r[0] is not None) == [(i, at(1), "x" * i) for i in range(7)]
    assert feeds.thinned(df, ["event_id", "kind"]).where("event_id IS NULL").count() == 1


def test_running_means_are_those_of_the_whole(spark, feed_path, tmp_path):
    result = feeds.run_available(feeds.running_means(feed(spark, feed_path), "kind", "value"), str(tmp_path / "out"))
    found = {r["kind"]: (r["value_sum"], r["record_count"]) for r in feeds.latest(spark, result, ["kind"]).collect()}
    assert found == {"a": (13.0, 5), "b": (4.0, 2)}
    batches = {r["batch"] for r in spark.read.parquet(result).select("batch").distinct().collect()}
    assert len(batches) == 3


def test_windows_match_a_batch_run(spark, feed_path, tmp_path):
    aggs = [F.count(F.lit(1)).alias("records"), F.sum("value").alias("total")]
    stream = feeds.window_totals(feed(spark, feed_path), aggs, "2 days", "1 day", ["kind"], lateness="30 days")
    result = feeds.run_available(stream, str(tmp_path / "out"))
    keys = ["window_start", "window_end", "kind"]
    batch = spark.read.parquet(feed_path).groupBy(F.window("ts", "2 days", "1 day").alias("w"), "kind").agg(*aggs)
    expected = sorted((r["w"]["start"], r["w"]["end"], r["kind"], r["records"], r["total"]) for r in batch.collect())
    found = sorted(tuple(r[k] for k in [*keys, "records", "total"]) for r in feeds.latest(spark, result, keys).collect())
    assert found == expected


def test_a_second_run_takes_only_new_files(spark, feed_path, tmp_path):
    out = str(tmp_path / "out")
    feeds.run_available(feeds.running_means(feed(spark, feed_path), "kind", "value"), out)
    spark.createDataFrame([(9, at(9), "a", 7.0)], "event_id long, ts timestamp, kind string, value double").coalesce(1).write.mode("append").parquet(feed_path)
    result = feeds.run_available(feeds.running_means(feed(spark, feed_path), "kind", "value"), out)
    sums = lambda **base: {r["kind"]: r["value_sum"] for r in feeds.latest(spark, result, ["kind"], **base).collect()}
    assert sums() == {"a": 20.0, "b": 4.0}
    first, second = str(tmp_path / "base1"), str(tmp_path / "base2")
    last = feeds.compacted(spark, result, ["kind"], first)
    assert sums(base=first) == sums() and spark.read.parquet(first).count() == 2
    spark.createDataFrame([(10, at(9), "b", 1.0)], "event_id long, ts timestamp, kind string, value double").coalesce(1).write.mode("append").parquet(feed_path)
    feeds.run_available(feeds.running_means(feed(spark, feed_path), "kind", "value"), out)
    assert sums(base=first) == sums() == {"a": 20.0, "b": 5.0}
    assert feeds.compacted(spark, result, ["kind"], second, earlier=first) > last
    assert sums(base=second) == {"a": 20.0, "b": 5.0}


def test_ticks(spark, feed_path, tmp_path):
    stream = feeds.live_ticks(feed(spark, feed_path), "1 day", F.col("kind") == "b", F.col("value"))
    result = feeds.run_available(stream, str(tmp_path / "out"))
    found = {r["window_start"].day: (r["records"], r["alerts"], r["score"]) for r in feeds.latest(spark, result, ["window_start", "window_end"]).collect()}
    assert found == {1: (4, 2, 1.5), 2: (2, 0, 3.0), 3: (2, 1, 5.0)}
