"""Tables whose gaps are NaN, as data frame libraries write them: every result is that of the same gaps as NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.operators import aggregates as agg
from newsmill.operators import clean, joins, quality, reshape, search
from newsmill.operators import timeseries as ts
from newsmill.operators.ordering import top_per_group
from newsmill.plans.registry import CATALOGUE, query
from newsmill.plans.stand_ins import RATED_SQL, dated, rated, rounded
from newsmill.session import table

def _nan() -> Column:
    return F.lit(float("nan"))


def _rated(spark: SparkSession, sf: str) -> DataFrame:
    return rated(spark, sf).withColumns({n: F.coalesce(n, _nan()) for n in ("rating_score", "mentions", "popularity")})


def _nan_if(gap: Column, name: str) -> Column:
    return F.when(gap, _nan()).otherwise(F.col(name))


def _as_with_null(name: str) -> str:
    """The SQL of the query over the same table with NULL for NaN."""
    return CATALOGUE[name].sql


@query("nan_insight_rows", 71, sql=_as_with_null("insight_rows"))
def _(spark, sf):
    names = ["primary_category", "analysis_year", "rating_score", "popularity", "content_length", "estimated_value", "analysis_document_type", "analysis_title"]
    return clean.insight_rows(_rated(spark, sf)).select("record_id", *names)


@query(
    "nan_top_per_group", 72,
    sql=f"""WITH {RATED_SQL} SELECT record_id, language, coalesce(rating_score, 0) AS rating_score, category FROM rated
    QUALIFY row_number() OVER (PARTITION BY language ORDER BY coalesce(rating_score, 0) DESC, record_id) <= 5""",
)
def _(spark, sf):
    return top_per_group(_rated(spark, sf), "language", "rating_score", "record_id", 5, keep=["category"])


@query("nan_article_metrics", 91, sql=_as_with_null("article_metrics"))
def _(spark, sf):
    out = clean.article_metrics(_rated(spark, sf), ["content_length"]).drop("published_date")
    return rounded(rounded(out, 4, "engagement_score"), 5, "estimated_value")


@query("nan_dashboard_rows", 99, sql=_as_with_null("dashboard_rows"))
def _(spark, sf):
    out = clean.dashboard_rows(_rated(spark, sf)).withColumn("title_length", F.col("title_length").cast("int"))
    return out.select("record_id", "title", "category", "language", "published_year", "rating_score", "title_length", "vote_count")


@query("nan_missing_report", 103, sql=_as_with_null("missing_report"))
def _(spark, sf):
    return quality.missing_report(_rated(spark, sf))


@query("nan_fill_medians", 117, sql=_as_with_null("fill_medians"))
def _(spark, sf):
    return clean.fill_medians(_rated(spark, sf).select("record_id", "rating_score", "mentions"), ["rating_score", "mentions"])


@query("nan_keyword_search", 127, sql=_as_with_null("keyword_search"))
def _(spark, sf):
    return search.keyword_search(_rated(spark, sf), "the ander und avec", n=25)


_LINES_SQL = """g AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_suppkey, CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS q FROM lineitem)"""


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").withColumn("l_quantity", _nan_if(F.col("l_orderkey") % 7 == 0, "l_quantity"))


@query(
    "nan_group_means", 45,
    sql=f"WITH {_LINES_SQL} SELECT l_orderkey, l_linenumber, round(avg(coalesce(q, 0)) OVER (PARTITION BY l_returnflag), 4) AS category_avg_l_quantity FROM g",
)
def _(spark, sf):
    out = joins.with_group_means(_lines(spark, sf), "l_returnflag", ["l_quantity"])
    return rounded(out, 4, "category_avg_l_quantity").select("l_orderkey", "l_linenumber", "category_avg_l_quantity")


@query(
    "nan_rating_stats", 62,
    sql=f"""WITH {_LINES_SQL} SELECT round(avg(q), 6) AS mean, round(stddev_pop(q), 6) AS std, max(q) AS max, min(l_suppkey) AS min_mentions, sum(l_suppkey)::BIGINT AS total_mentions FROM g""",
)
def _(spark, sf):
    return rounded(agg.rating_stats(_lines(spark, sf), "l_quantity", "l_suppkey"), 6, "mean", "std")


@query(
    "nan_widen_mean", 81,
    sql=f"""WITH {_LINES_SQL} SELECT l_linestatus, round(avg(q) FILTER (l_returnflag = 'A'), 6) AS "A", round(avg(q) FILTER (l_returnflag = 'N'), 6) AS "N" FROM g GROUP BY 1""",
)
def _(spark, sf):
    return rounded(reshape.widen_mean(_lines(spark, sf), ["l_linestatus"], "l_returnflag", "l_quantity", ["A", "N"]), 6, "A", "N")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return dated(spark, sf).withColumn("estimated_value", _nan_if(F.col("record_id") % 7 == 0, "estimated_value"))


def _series_sql(unit: str, median: bool) -> str:
    extra = ", round(median(v), 4) AS median_estimated_value" if median else ""
    return f"""SELECT last_day((p + INTERVAL {2 if unit == 'quarter' else 0} MONTH)::DATE) AS analysis_date, count(*) AS article_count, round(sum(v), 2) AS total_estimated_value,
      round(avg(v), 4) AS avg_estimated_value{extra}
    FROM (SELECT date_trunc('{unit}', o_orderdate)::DATE AS p, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_totalprice / 997 END AS v FROM orders) GROUP BY p"""


@query("nan_monthly_series", 134, sql=_series_sql("month", True))
def _(spark, sf):
    return rounded(rounded(ts.monthly(_orders(spark, sf)), 2, "total_estimated_value"), 4, "avg_estimated_value", "median_estimated_value")


@query("nan_quarterly_series", 135, sql=_series_sql("quarter", False))
def _(spark, sf):
    return rounded(rounded(ts.quarterly(_orders(spark, sf)), 2, "total_estimated_value"), 4, "avg_estimated_value")


@query(
    "nan_thresholds", 9, 30, 32,
    sql="""WITH g AS (SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS q FROM lineitem)
    SELECT 'at least' AS filter, count(*) AS n FROM g WHERE q >= 30 UNION ALL SELECT 'mentioned', count(*) FROM g WHERE l_linenumber > 2 AND coalesce(q, 0) >= 20 AND l_suppkey > 3
    UNION ALL SELECT 'metrics', count(*) FROM g WHERE q >= 40""",
)
def _(spark, sf):
    from newsmill.operators import select
    from newsmill.sources import stores

    lines = _lines(spark, sf)
    found = {
        "at least": select.at_least(lines, 30, "l_quantity", ["l_orderkey"]),
        "mentioned": select.rated_and_mentioned(lines, 2, 20, 3, "l_linenumber", "l_quantity", "l_suppkey"),
        "metrics": stores.scan_metrics(lines, "l_quantity", 40),
    }
    rows = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("filter"), "n") for name, df in found.items()]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])
