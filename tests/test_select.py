import pytest

from newsmill.operators import select


@pytest.fixture
def rows(spark):
    data = [(1, "en", 7.0, "7.5"), (2, None, 9.0, "x"), (3, "de", None, None), (4, "fr", float("nan"), "NaN")]
    return spark.createDataFrame(data, "record_id int, language string, rating_score double, raw string")


def ids(df):
    return sorted(r["record_id"] for r in df.collect())


def test_threshold_fails_null_and_nan(rows):
    assert ids(select.at_least(rows, 7.0)) == [1, 2]
    assert ids(select.at_least(rows, 7.0, "raw", ["record_id"])) == [1]
    assert select.at_least(rows.select("record_id")).count() == 0


def test_exclusion_keeps_null(rows):
    assert ids(select.in_values(rows, ["en"])) == [1]
    assert ids(select.in_values(rows, ["en"], exclude=True)) == [2, 3, 4]
    assert ids(select.in_values(rows, None, "raw")) == [1, 2, 4]


def test_range_includes_both_ends(rows):
    assert ids(select.between(rows, 7.0, 9.0)) == [1, 2]


def test_filters_reach_the_scan(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").withColumnRenamed("o_totalprice", "rating_score")
    plan = select.at_least(orders, 300000.0, keep=["o_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_totalprice,300000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_predicate_tree(rows):
    assert ids(select.matching(rows, {"$or": [{"language": "en"}, {"rating_score": {"$gt": 8, "$lt": 10}}]})) == [1, 2]
    assert ids(select.matching(rows, {"record_id": {"$nin": [1, 2], "$ne": 3}})) == [4]
    assert select.matching(rows, None) is rows
    with pytest.raises(ValueError):
        select.predicate({"$and": [{}]})
    with pytest.raises(KeyError):
        select.predicate({"language": {"$like": "x"}})


def test_search_text_is_literal(spark):
    data = [(1, "A.B", "x", "x", "c", "d", 0), (2, "AxB", "x", "x", "c", "d", 2001), (3, None, None, None, "c", "d", 1990)]
    df = spark.createDataFrame(data, "record_id int, title string, content_text string, overview string, category string, document_type string, published_year int")
    assert ids(select.faceted(df, search="a.b")) == [1]
    assert ids(select.faceted(df, years=(2000, 2010))) == [1, 2]


def test_years_of_nothing(spark):
    df = spark.createDataFrame([(0,), (None,)], "published_year int")
    assert tuple(select.year_range(df).first()) == select.DEFAULT_YEARS


def test_short_text_counts_null_as_empty(spark):
    df = spark.createDataFrame([(1, None), (2, "x" * 40), (3, "x" * 39)], "record_id int, overview string")
    assert ids(select.short_texts(df)) == [1, 3]
    assert [r["is_short_content"] for r in select.flag_short(df).orderBy("record_id").collect()] == [True, False, True]
