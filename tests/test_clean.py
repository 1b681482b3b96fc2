import pytest
from pyspark.sql import functions as F

from newsmill.functions import text as tx
from newsmill.operators import clean, dedup, quality
from newsmill.plans import cleaning


def column(df, name, order="seq"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


def test_missing_report_finds_gaps(news):
    found = {r["column"]: r["missing_count"] for r in quality.missing_report(news).collect()}
    assert found["content_text"] == 2 and found["rating_score"] == 1 and "title" not in found


def test_incomplete_rows_go(news):
    assert column(clean.drop_incomplete(news), "record_id") == [1, 2, 2, 4]


def test_overview_gets_its_placeholder(news):
    values = column(clean.fill_overview(news), "overview")
    assert values[1] == values[3] == tx.NO_OVERVIEW and values[4] == "Sports story content"


def test_zero_becomes_null_and_median_fills(news):
    gaps = clean.zero_to_null(news, ["rating_score"])
    assert column(gaps, "rating_score") == [4.0, None, None, None, 6.0]
    assert column(clean.fill_medians(gaps, ["rating_score"]), "rating_score") == [4.0, 5.0, 5.0, 5.0, 6.0]


def test_median_of_nothing_leaves_the_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "seq int, v double")
    assert column(clean.fill_medians(df, ["v"]), "v") == [None, None]


def test_sparse_columns_go_unless_protected(spark):
    df = spark.createDataFrame([("A", "x", None), ("B", "y", None), ("C", "z", "v")], "title string, content_text string, mostly string")
    assert clean.drop_sparse(df, 0.5, ["title"]).columns == ["title", "content_text"]
    assert clean.drop_sparse(df, 0.5, ["mostly"]).columns == df.columns


def test_titles(news):
    titles = column(clean.clean_titles(news), "title")
    assert titles[0] == "Election Update" and titles[3] == tx.UNTITLED


def test_inner_gap_of_a_removed_year_stays(spark):
    df = spark.createDataFrame([(1, "A (2020) B"), (2, None)], "seq int, title string")
    assert column(clean.clean_titles(df), "title") == ["A  B", tx.UNTITLED]


def test_languages(news):
    assert column(clean.clean_languages(news), "language") == ["en", "unknown", "unknown", "unknown", "unknown"]


def test_bodies(news):
    out = clean.clean_bodies(news)
    assert column(out, "content_text")[0] == "Election news text"
    assert column(out, "overview") == column(out, "content_text")
    assert column(out, "content_text")[1] == tx.NO_CONTENT


def test_years_and_labels(news):
    assert column(clean.clean_years(news), "published_year") == [2026, 2026, 2026, None, 2026]
    out = clean.clean_labels(news)
    assert column(out, "category")[0] == "politics" and column(out, "document_type")[1] == "news_api"


def test_equal_rows_with_nested_values(spark):
    rows = [(1, 1, "A", ["x"], {"k": 1}), (2, 1, "A", ["x"], {"k": 1}), (3, 2, "B", ["y"], {}), (4, 1, "A", ["x", "x"], {"k": 1})]
    df = spark.createDataFrame(rows, "seq int, record_id int, title string, tags array<string>, m map<string,int>")
    assert column(dedup.distinct_rows(df, ignore=["seq"]), "seq") == [1, 3, 4]


def test_null_equals_null_in_equal_rows(spark):
    df = spark.createDataFrame([(2, None, "a"), (1, None, "a"), (3, "", "a")], "seq int, x string, y string")
    assert column(dedup.distinct_rows(df, ignore=["seq"]), "seq") == [1, 3]


def test_rows_with_unlike_ids_are_not_equal(spark):
    rows = [(1, "Title", "text", None, None), (2, "Title", "text", None, None), (2, "Title", "text", None, None)]
    df = spark.createDataFrame(rows, "record_id long, title string, content_text string, url string, published_date string")
    assert sorted(r.record_id for r in dedup.distinct_rows(df).collect()) == [1, 2]
    assert sorted(r.record_id for r in cleaning.deduplicate(df, ["record_id"]).collect()) == [1, 2]
    gaps = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert dedup.distinct_rows(gaps).count() == 2


def test_rows_without_keys_stay_where_the_order_repeats(spark):
    df = spark.createDataFrame([(1, "a", None, None), (1, "b", None, None), (1, "c", "u", "2026-01-01"), (1, "d", "u", "2026-01-01")], "seq int, title string, url string, published_date string")
    assert dedup.by_url(df, ["seq"]).count() == 3
    assert dedup.by_title_and_date(df, ["seq"]).count() == 4
    assert cleaning.deduplicate(df, ["seq"]).count() == 3


def test_repeats(news, spark):
    assert dedup.repeats(news, "record_id").first()[0] == 1
    nulls = spark.createDataFrame([(None,), (None,), (1,), (1,), (2,)], "v int")
    assert dedup.repeats(nulls, "v").first()[0] == 2
    assert dedup.repeats(nulls, "no_such").first()[0] == 0


def test_keep_first_by_id_url_and_title(news):
    assert column(dedup.by_id(news, ["seq"]), "record_id") == [1, 2, 3, 4]
    assert column(dedup.by_url(news, ["seq"]), "record_id") == [1, 2, 3, 4]
    assert column(dedup.by_title_and_date(news, ["seq"]), "record_id") == [1, 2, 3, 4]


def test_rows_without_a_url_all_stay(spark):
    rows = [(i, None if i % 3 == 0 else (" " if i % 3 == 1 else "u")) for i in range(30)]
    df = spark.createDataFrame(rows, "seq int, url string")
    kept = column(dedup.by_url(df, ["seq"]), "seq")
    assert kept == sorted([i for i in range(30) if i % 3 != 2] + [2])


def test_dedup_limits_rows_before_the_shuffle(news):
    plan = dedup.by_url(news, ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 1


def test_types(news):
    out = clean.convert_types(news)
    types = dict(out.dtypes)
    assert types["published_date"] == "timestamp" and types["rating_score"] == "float" and types["record_id"] == "bigint"
    assert out.where("published_date IS NULL").count() == 1


def test_whole_numbers_round_half_even(spark):
    df = spark.createDataFrame([(1, "2.5"), (2, "3.5"), (3, "x"), (4, "-0.5"), (5, "NaN")], "seq int, year string")
    assert column(clean.convert_numbers(df), "year") == [2, 4, None, 0, None]


def test_validation(spark):
    good = spark.createDataFrame([("Election Update", "en"), ("AI", "unknown")], "title string, language string")
    assert {r["check"] for r in quality.validate(good).collect() if not r["passed"]} == {"required_columns"}
    bad = spark.createDataFrame([("T", ""), ("", "english")], "title string, language string")
    failed = {r["check"]: r["violations"] for r in quality.validate(bad).collect() if not r["passed"]}
    assert failed["null_titles"] == 1 and failed["language_codes"] == 2


def test_score_out_of_range(spark):
    df = spark.createDataFrame([(5.0,), (15.0,), (None,)], "rating_score double")
    assert {r["check"]: r["violations"] for r in quality.validate(df).collect()}["rating_score_range"] == 1


def test_whole_run_is_valid(news):
    out = cleaning.clean_all(news, ["seq"], arrival=["seq"])
    assert quality.require_valid(out) == {"passed": 7, "failed": 0}
    assert sorted(column(out, "record_id")) == [1, 2, 4]
    with pytest.raises(quality.ValidationError):
        quality.require_valid(out.withColumn("rating_score", F.lit(11.0)))


def test_run_from_csv_to_csv(news, spark, tmp_path):
    from newsmill.sources.files import read_csv

    paths = cleaning.clean_and_save(news, ["seq"], str(tmp_path))
    names = spark.read.csv(paths["cleaned_data"], header=True).columns
    saved = read_csv(spark, paths["cleaned_data"], {n: "string" for n in names})
    assert sorted(column(saved, "title", "title")) == ["AI Market Growth", "Election Update", "Sports Highlights"]
    gaps = {r["column"] for r in spark.read.csv(paths["missing_report"], header=True).collect()}
    assert gaps == {"content_text", "overview", "language", "rating_score", "vote_average", "popularity", "vote_count", "url"}


def test_metrics_keep_the_first_row_per_id(spark):
    rows = [(1, "7", "T", 2.0, 10), (2, "7", "U", 9.0, 10), (3, "record_id", "title", 1.0, 1), (4, None, "V", 1.0, 1), (5, "8", " ", 1.0, 1)]
    df = spark.createDataFrame(rows, "seq int, record_id string, title string, rating_score double, content_length int")
    out = clean.article_metrics(df, ["seq"]).collect()
    assert [(r["record_id"], r["title"], r["primary_category"]) for r in out] == [(7, "T", "unknown")]
    assert out[0]["engagement_score"] == pytest.approx(20.1) and out[0]["estimated_value"] == pytest.approx(20.1 * 11)


def test_empty_input(spark, news):
    nothing = news.where("false")
    assert quality.full_report(nothing).count() == 0
    assert cleaning.clean_all(nothing, ["seq"], arrival=["seq"]).count() == 0
    assert quality.outlier_report(nothing).count() == 0
