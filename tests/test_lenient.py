"""Bad values become NULL, repeated keys become one row, and no range of a quantile stays crowded."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.operators import aggregates, clean, joins, quantiles, select
from newsmill.plans.normalise import normalise
from newsmill.sources import files, stores


@pytest.mark.parametrize("value", ["id / 1e9", "1.7e9 + id / 1e6", "1000000 + id / 100000", "pow(2.0, -id / 100.0)", "CASE WHEN id % 2 = 0 THEN 0.5 ELSE id / 1e9 END"])
def test_quantiles_of_crowded_ranges(spark, monkeypatch, value):
    monkeypatch.setattr(quantiles, "RANGE_ROWS", 500)
    df = spark.range(100_000).select(F.expr(f"CAST({value} AS DOUBLE)").alias("v"))
    got = quantiles.exact_quantiles(df, ["v"], {"a": 0.25, "b": 0.5, "c": 0.999}).first()
    expected = df.agg(*[F.percentile("v", p).alias(n) for n, p in (("a", 0.25), ("b", 0.5), ("c", 0.999))]).first()
    assert (got.a, got.b, got.c) == pytest.approx((expected.a, expected.b, expected.c), rel=1e-12)


def test_quantiles_without_nan_and_with_infinity(spark):
    df = spark.createDataFrame([("g", x) for x in (1.0, 2.0, 3.0, float("nan"), None)] + [("h", float("inf")), ("h", 1.0), ("h", float("-inf"))], "g string, v double")
    got = {r.g: (r.n, r.m) for r in quantiles.exact_quantiles(df, ["v"], {"m": 0.5}, ["g"]).collect()}
    assert got == {"g": (3, 2.0), "h": (3, 1.0)}
    assert aggregates.global_mean(df.where("g = 'g'"), "v").first().global_mean == 2.0
    assert aggregates.describe_numbers(df.where("g = 'g'"), ["v"]).first()["max"] == 3.0


def test_years_that_overflow(spark):
    df = spark.createDataFrame([(1, "99999999999", 1.0), (2, "2024", 2.0)], "record_id long, published_year string, rating_score double")
    years = {r.record_id: r.analysis_year for r in clean.with_analysis_year(df).collect()}
    assert years == {1: None, 2: 2024}
    assert clean.dashboard_rows(df).count() == 2
    assert select.year_range(df).count() == 1
    with_year = clean.with_analysis_year(df)
    assert aggregates.yearly_summary(with_year).count() == 1


def test_values_that_do_not_fit_a_table(spark):
    df = spark.createDataFrame([(4_000_000_000,), (5,)], "n long")
    assert [r.n for r in stores.conform(df, T.StructType([T.StructField("n", T.IntegerType())])).collect()] == [None, 5]


def test_blank_titles(spark):
    df = spark.createDataFrame([(1, "\t\n　", "file.pdf", "text")], "record_id long, title string, file_name string, description string")
    assert normalise(df).first().title == "file.pdf"


def test_repeated_keys_in_an_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (2, "d"), (3, "e"), (3, "e")], "k int, v string")
    rows = sorted(tuple(r) for r in joins.upsert(old, new, "k").collect())
    assert [k for k, _ in rows] == [1, 2, 3] and rows[1][1] in ("c", "d")
    assert rows == sorted(tuple(r) for r in joins.upsert(old, new.repartition(7), "k").collect())
    assert sorted(r.k for r in joins.merge_fields(old, new, "k").collect()) == [1, 2, 3]
    assert [r.k for r in joins.only_new(old, new, "k").collect()] == [3]


def test_fallback_from_a_broken_file(spark, tmp_path):
    broken = tmp_path / "broken.parquet"
    broken.write_bytes(b"PAR1 no such thing")
    spare = spark.createDataFrame([(1,)], "n int")
    assert files.with_fallback(lambda: spark.read.parquet(str(broken)), lambda: spare).first().n == 1
    assert files.with_fallback(lambda: spark.read.schema("n int").parquet(str(broken)), lambda: spare).first().n == 1


def test_text_column_without_a_value_is_described(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (None, "b")], "x string, y string")
    got = {r.column: (r["count"], r.unique, r.top, r.freq) for r in aggregates.describe_all(df).collect()}
    assert got == {"x": (0, 0, None, None), "y": (3, 2, "a", 2)}


def test_category_groups_leave_out_records_without_any_field(spark):
    df = spark.createDataFrame([(1, None, None, "t"), (2, "c", None, "t"), (3, None, "s", "t")], "record_id long, category string, source string, title string")
    assert sum(r.record_count for r in aggregates.store_category_groups(df, "record_id").collect()) == 2


def test_thinning_keeps_the_copy_that_is_in_time(spark):
    from newsmill.streaming.feeds import thinned

    rows = [(7, "2026-01-01 00:00:00"), (7, "2026-01-05 00:00:00"), (8, "2026-01-02 00:00:00"), (7, "2026-01-03 00:00:00")]
    df = spark.createDataFrame(rows, "event_id long, ts string").select("event_id", F.to_timestamp("ts").alias("ts")).coalesce(1)
    assert sorted((r.event_id, r.ts.day) for r in thinned(df, ["event_id"]).collect()) == [(7, 5), (8, 2)]


def test_top_rows_of_a_group_beyond_the_group_limit(spark):
    from newsmill.operators.ordering import keep_first

    df = spark.range(5000).select((F.col("id") % 2).alias("g"), "id")
    got = keep_first(df, [F.col("g")], [F.col("id").desc()], 1500).groupBy("g").agg(F.count("id").alias("n"), F.min("id").alias("lo")).orderBy("g").collect()
    assert [(r.n, r.lo) for r in got] == [(1500, 2000), (1500, 2001)]
