"""Sessions in batches and streams, and ingest against what is stored."""

import datetime as dt

from pyspark.sql import functions as F

from newsmill.operators.timeseries import sessions
from newsmill.streaming import feeds

DAY = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
SCHEMA = "user string, ts timestamp, value double"


def at(minutes):
    return DAY + dt.timedelta(minutes=minutes)


def test_sessions_across_buckets(spark):
    minutes = [0, 30, 61, 1430, 1445, 1470, 1501, 2880]
    rows = [("a", at(m), float(m)) for m in minutes] + [("b", at(1439), float("nan")), ("b", at(1440), 2.0), (None, at(5), 1.0), ("c", None, 9.0)]
    got = sessions(spark.createDataFrame(rows, SCHEMA).repartition(5), "30 minutes", ["user"], sums=["value"], lows=["value"])
    out = sorted((r.user or "", (r.session_start.replace(tzinfo=dt.timezone.utc) - DAY).total_seconds() / 60, r.records, r.total_value, r.min_value) for r in got.collect())
    # A row exactly one gap later still belongs to the session.
    assert out == [("", 5, 1, 1.0, 1.0), ("a", 0, 2, 30.0, 0.0), ("a", 61, 1, 61.0, 61.0), ("a", 1430, 3, 4345.0, 1430.0), ("a", 1501, 1, 1501.0, 1501.0), ("a", 2880, 1, 2880.0, 2880.0), ("b", 1439, 2, 2.0, 2.0)]
    assert sessions(got.limit(0).select("user", F.col("session_start").alias("ts"), F.lit(1.0).alias("value")), "1 hour", ["user"]).count() == 0


def test_a_late_row_joins_two_sessions(spark, tmp_path):
    def load(number, rows):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/in/load={number}")
        feed = feeds.parquet_feed(spark, f"{tmp_path}/in/*", schema=spark.createDataFrame([], SCHEMA).schema)
        feeds.run_available(feeds.session_totals(feed, [F.count(F.lit(1)).alias("records")], "30 minutes", ["user"], lateness="2 hours"), f"{tmp_path}/out", "append")
        return sorted((r.user, r.records) for r in spark.read.parquet(f"{tmp_path}/out/result").collect())

    assert load(0, [("a", at(0), 1.0), ("a", at(50), 1.0), ("b", at(0), 1.0)]) == []
    # The row between the two is 100 minutes late; the last one closes what lies before.
    assert load(1, [("a", at(25), 1.0), ("c", at(125), 1.0)]) == []
    assert load(2, [("c", at(300), 1.0)]) == [("a", 3), ("b", 1), ("c", 1)]
    assert load(3, [("a", at(10), 1.0), ("z", at(310), 1.0)]) == [("a", 3), ("b", 1), ("c", 1)]  # too late


def test_ingest_adds_each_key_once(spark, tmp_path):
    path, state = f"{tmp_path}/table", f"{tmp_path}/state"
    schema = "id long, ts timestamp, text string"

    def deliver(number, ids, state=state):
        spark.createDataFrame([(k, at(0), f"load {number}") for k in ids], schema).write.parquet(f"{tmp_path}/in/load={number}")
        feed = feeds.parquet_feed(spark, f"{tmp_path}/in/*", schema=spark.createDataFrame([], schema).schema)
        return feeds.ingest_new(feed, path, ["id"], state, blocks=4)

    stored = lambda: sorted((r.id, r.text) for r in spark.read.parquet(path).collect())
    deliver(0, [1, 2, 2, None])
    deliver(1, [2, 3])
    assert deliver(2, range(1, 200)) == 3
    expected = [(1, "load 0"), (2, "load 0"), (3, "load 1"), *((k, "load 2") for k in range(4, 200))]
    assert stored() == expected
    # The last batch runs again: its rows replace themselves.
    (last,) = [p for p in (tmp_path / "state" / "commits").iterdir() if p.name == "2"]
    last.unlink()
    (tmp_path / "state" / "commits" / ".2.crc").unlink(missing_ok=True)
    feed = feeds.parquet_feed(spark, f"{tmp_path}/in/*", schema=spark.createDataFrame([], schema).schema)
    feeds.ingest_new(feed, path, ["id"], state, blocks=4)
    assert stored() == expected


def test_ingest_reads_only_ranges_of_possible_hits(spark, tmp_path):
    from newsmill.sources.keyfilter import Keys

    keys = Keys(spark, f"{tmp_path}/keys", ["id"])
    keys.add(spark.range(1000), 0)
    fresh = keys.missing_from(spark.range(5000, 5100))
    assert fresh.count() == 100
    plan = keys.missing_from(spark.range(7, 8))
    assert plan.count() == 0
    files = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in files and "range" in files
