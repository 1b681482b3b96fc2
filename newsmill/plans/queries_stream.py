"""Streams over the event feed; each runs over everything there is and then stops.

Those with late rows get the events in three loads, and go on from their state after each: the first half by time,
the second half, and every tenth event, whenever it was.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from newsmill.operators.timeseries import sessions
from newsmill.plans.registry import query
from newsmill.plans.stand_ins import rounded
from newsmill.session import scratch_path, table
from newsmill.streaming import feeds


def _feed(spark, sf):
    return feeds.parquet_feed(spark, f"{sf}/events.parquet")


def _ntz(df, *names):
    return df.withColumns({n: feeds.utc_time(F.col(n)) for n in names})


@query(
    "live_ticks", 136,
    sql="""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS records,
    count(*) FILTER (event_type = 'error') AS alerts, round(avg(value), 6) AS score FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 60""",
)
def _(spark, sf):
    stream = feeds.live_ticks(_feed(spark, sf), "1 hour", F.col("event_type") == "error", F.col("value"))
    result = feeds.run_available(stream, scratch_path(spark, "ticks"))
    last = feeds.latest(spark, result, ["window_start", "window_end"]).orderBy(F.desc("window_start")).limit(60)
    return rounded(_ntz(last, "window_start", "window_end"), 6, "score")


@query("new_events", 137, sql="SELECT event_id, ts, user_id, event_type, value FROM events")
def _(spark, sf):
    # Every event is delivered twice.
    twice = _feed(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy", "props")
    result = feeds.run_available(feeds.new_events(twice, ["event_id"]), scratch_path(spark, "new"), "append")
    return _ntz(spark.read.parquet(result).drop("batch"), "ts")


@query(
    "running_means", 138,
    sql="SELECT event_type, round(sum(value), 2) AS value_sum, count(*) AS record_count, round(avg(value), 6) AS mean_value FROM events GROUP BY 1",
)
def _(spark, sf):
    stream = feeds.running_means(_feed(spark, sf), "event_type", "value")
    out = feeds.latest(spark, feeds.run_available(stream, scratch_path(spark, "means")), ["event_type"])
    return rounded(rounded(out, 2, "value_sum"), 6, "mean_value")


@query(
    "tumbling_windows", 139,
    sql="""SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, event_type, count(*) AS records, round(sum(value), 2) AS total FROM events GROUP BY ALL""",
)
def _(spark, sf):
    aggs = [F.count(F.lit(1)).alias("records"), F.sum("value").alias("total")]
    stream = feeds.window_totals(_feed(spark, sf), aggs, "1 day", groups=["event_type"])
    out = feeds.latest(spark, feeds.run_available(stream, scratch_path(spark, "daily")), ["window_start", "window_end", "event_type"])
    return rounded(_ntz(out, "window_start", "window_end"), 2, "total")


@query(
    "sliding_windows", 139,
    sql="""SELECT w AS window_start, w + INTERVAL 3 DAY AS window_end, count(*) AS records, round(avg(value), 6) AS mean_value
    FROM (SELECT value, unnest([time_bucket(INTERVAL 1 DAY, ts), time_bucket(INTERVAL 1 DAY, ts) - INTERVAL 1 DAY, time_bucket(INTERVAL 1 DAY, ts) - INTERVAL 2 DAY]) AS w FROM events) GROUP BY w""",
)
def _(spark, sf):
    aggs = [F.count(F.lit(1)).alias("records"), F.avg("value").alias("mean_value")]
    stream = feeds.window_totals(_feed(spark, sf), aggs, "3 days", "1 day")
    out = feeds.latest(spark, feeds.run_available(stream, scratch_path(spark, "sliding")), ["window_start", "window_end"])
    return rounded(_ntz(out, "window_start", "window_end"), 6, "mean_value")


_GAP = "INTERVAL 30 MINUTE"


def _sessions_sql(rows: str) -> str:
    return f"""s AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (
      SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= {_GAP} THEN 0 ELSE 1 END AS begins FROM {rows})),
    r AS (SELECT user_id, min(ts) AS session_start, max(ts) + {_GAP} AS session_end, count(*) AS records, round(sum(value), 2) AS total_value, max(value) AS max_value FROM s GROUP BY user_id, session)"""


@query("user_sessions", 139, sql=f"WITH {_sessions_sql('events')} SELECT * FROM r")
def _(spark, sf):
    events = table(spark, sf, "events").withColumn("ts", feeds.as_utc("ts"))
    out = sessions(events, "30 minutes", ["user_id"], sums=["value"], highs=["value"])
    return rounded(_ntz(out, "session_start", "session_end"), 2, "total_value")


# The loads, the watermark of each load (a day before the latest event of the earlier ones), and what comes in time.
_LOADS_SQL = """l AS (SELECT *, CASE WHEN event_id % 10 = 3 THEN 2 WHEN ts < date_trunc('day', (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events)) THEN 0 ELSE 1 END AS load FROM events),
    w AS (SELECT n AS load, (SELECT max(ts) FROM l WHERE l.load < n) - INTERVAL 1 DAY AS mark FROM (VALUES (0), (1), (2), (3)) AS v(n))"""


def _loads(spark, sf) -> list:
    events = table(spark, sf, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    half = F.lit((low + (high - low) / 2).replace(hour=0, minute=0, second=0, microsecond=0)).cast("timestamp_ntz")
    late = F.col("event_id") % 10 == 3
    return [events.where(~late & (F.col("ts") < half)), events.where(~late & (F.col("ts") >= half)), events.where(late)]


def _loaded(spark, sf, label: str, run) -> None:
    """Calls ``run(feed)`` after each load of a folder that the feed reads."""
    folder = scratch_path(spark, label)
    for number, rows in enumerate(_loads(spark, sf)):
        rows.write.parquet(f"{folder}/load={number}")
        run(feeds.parquet_feed(spark, f"{folder}/*", schema=rows.schema))


@query(
    "closed_sessions", 139,
    sql=f"""WITH {_LOADS_SQL}, k AS (SELECT l.* FROM l JOIN w USING (load) WHERE mark IS NULL OR ts + {_GAP} > mark), {_sessions_sql('k')}
    SELECT * FROM r WHERE session_end <= (SELECT mark FROM w WHERE load = 3)""",
)
def _(spark, sf):
    out = scratch_path(spark, "sessions")
    aggs = [F.count(F.lit(1)).alias("records"), F.sum("value").alias("total_value"), F.max("value").alias("max_value")]
    _loaded(spark, sf, "session-loads", lambda feed: feeds.run_available(feeds.session_totals(feed, aggs, "30 minutes", ["user_id"]), out, "append"))
    closed = spark.read.parquet(f"{out}/result").drop("batch")
    return rounded(_ntz(closed, "session_start", "session_end"), 2, "total_value")


@query(
    "late_windows", 136, 139,
    sql=f"""WITH {_LOADS_SQL} SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS records, round(sum(value), 2) AS total
    FROM l JOIN w USING (load) WHERE mark IS NULL OR time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR > mark GROUP BY ALL""",
)
def _(spark, sf):
    out = scratch_path(spark, "late")
    aggs = [F.count(F.lit(1)).alias("records"), F.sum("value").alias("total")]
    _loaded(spark, sf, "late-loads", lambda feed: feeds.run_available(feeds.window_totals(feed, aggs, "1 hour", groups=["event_type"]), out))
    rows = feeds.latest(spark, f"{out}/result", ["window_start", "window_end", "event_type"]).drop("window_end")
    return rounded(_ntz(rows, "window_start"), 2, "total")


@query("ingested_events", 130, 137, sql="SELECT event_id, ts, user_id, event_type, value FROM events")
def _(spark, sf):
    # Every load holds what the earlier ones held; then all is delivered again to a stream without state.
    path, state = scratch_path(spark, "ingested"), scratch_path(spark, "ingest-state")
    folder = scratch_path(spark, "ingest-loads")
    loads = _loads(spark, sf)
    for number in range(len(loads)):
        for rows in loads[: number + 1]:
            rows.write.mode("append").parquet(f"{folder}/load={number}")
        feeds.ingest_new(feeds.parquet_feed(spark, f"{folder}/*", schema=loads[0].schema).drop("props"), path, ["event_id"], state)
    return _ntz(spark.read.parquet(path).drop("batch"), "ts")
