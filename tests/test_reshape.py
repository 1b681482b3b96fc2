import datetime as dt

import pytest
from pyspark.errors import PySparkException

from newsmill.operators import reshape
from newsmill.operators import timeseries as ts


@pytest.fixture
def sales(spark):
    rows = [(2020, "a", 1.0), (2020, "a", 3.0), (2020, "b", None), (2021, "b", 8.0), (None, "a", 100.0), (2021, None, 50.0)]
    return spark.createDataFrame(rows, "y int, c string, v double")


def test_margins_come_from_complete_rows(sales):
    found = {r["y"]: (r["a"], r["b"], r["All"]) for r in reshape.pivot_table(sales, "v", "y", "c", margins=True).collect()}
    assert found == {"2020": (2.0, 0.0, 2.0), "2021": (0.0, 8.0, 8.0), "All": (2.0, 8.0, 4.0)}


def test_pivot_without_margins(sales):
    found = {r["y"]: (r["a"], r["b"]) for r in reshape.pivot_table(sales, "v", "y", "c", "count", fill=None).collect()}
    assert found == {"2020": (2, 0), "2021": (None, 1)}


def test_crosstab_shares_by_column(sales):
    found = {r["y"]: (r["a"], r["b"], r["All"]) for r in reshape.crosstab(sales, "y", "c", "columns").collect()}
    assert found["2020"] == (1.0, 0.5, 0.75) and found["2021"] == (0.0, 0.5, 0.25)


def test_repeated_pair_is_an_error(sales):
    with pytest.raises(PySparkException, match="repeated"):
        reshape.widen(sales, "y", "c", "v").collect()


def test_melt_keeps_null_and_wants_three_measures(spark):
    df = spark.createDataFrame([(1, None, 2.0, 3)], "record_id int, popularity double, rating_score double, content_length int")
    assert sorted((r["metric"], r["value"]) for r in reshape.melt_metrics(df).collect()) == [("content_length", 3.0), ("popularity", None), ("rating_score", 2.0)]
    with pytest.raises(ValueError):
        reshape.melt_metrics(df.drop("popularity"))


def test_wide_rows_with_a_null_index_vanish(spark):
    df = spark.createDataFrame([(1, "m", 2.0), (1, "m", 4.0), (None, "m", 9.0)], "record_id int, metric string, value double")
    assert [tuple(r) for r in reshape.widen_mean(df, ["record_id"]).collect()] == [(1, 3.0)]


def test_months_without_rows_are_present(spark):
    rows = [(1, "2024-01-31", 2.0), (2, "2024-01-05", None), (3, "2024-04-01", 9.0), (4, "no date", 5.0), (5, None, 5.0)]
    df = spark.createDataFrame(rows, "record_id int, published_date string, estimated_value double")
    found = [tuple(r) for r in ts.monthly(df).collect()]
    day = dt.date
    assert found == [
        (day(2024, 1, 31), 2, 2.0, 1.0, 1.0), (day(2024, 2, 29), 0, 0.0, None, None), (day(2024, 3, 31), 0, 0.0, None, None), (day(2024, 4, 30), 1, 9.0, 9.0, 9.0),
    ]
    rolled = ts.with_rolling_means(ts.monthly(df), "total_estimated_value", windows=(3,)).orderBy("analysis_date")
    assert [r["rolling_3_month_avg"] for r in rolled.collect()] == [2.0, 1.0, pytest.approx(2 / 3), 3.0]
    assert [tuple(r)[:3] for r in ts.quarterly(df).collect()] == [(day(2024, 3, 31), 2, 2.0), (day(2024, 6, 30), 1, 9.0)]
    assert [tuple(r)[:3] for r in ts.yearly(df).collect()] == [(day(2024, 12, 31), 3, 11.0)]


def test_series_of_nothing(spark):
    df = spark.createDataFrame([(1, "no date", 2.0)], "record_id int, published_date string, estimated_value double")
    assert ts.monthly(df).collect() == []
    with pytest.raises(KeyError):
        ts.monthly(df.drop("estimated_value"))


def test_weekday_starts_on_monday(spark):
    df = spark.createDataFrame([("2024-01-01",), (None,)], "published_date string")
    row, none = ts.with_date_parts(df).collect()
    assert (row["analysis_weekday"], row["analysis_weekday_name"], row["analysis_month_name"], row["analysis_quarter"]) == (0, "Monday", "January", 1)
    assert none["analysis_year"] is None
