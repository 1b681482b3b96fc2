"""Summaries, profiles, chart data, rankings."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from newsmill.operators import aggregates as agg
from newsmill.operators import clean
from newsmill.operators.ordering import top_per_group
from newsmill.plans import dashboard, insights
from newsmill.plans.registry import query
from newsmill.plans.stand_ins import DATED_SQL, MEASURED_SQL, RATED_SQL, articles, dated, measured, rated, rounded
from newsmill.session import table


@query(
    "category_summary", 48, 13,
    sql=f"""WITH {MEASURED_SQL} SELECT primary_category, count(record_id) AS article_count, round(avg(rating_score), 4) AS avg_rating_score,
      median(rating_score) AS median_rating_score, round(sum(estimated_value), 2) AS total_estimated_value,
      round(avg(estimated_value), 4) AS avg_estimated_value, round(median(estimated_value), 4) AS median_estimated_value,
      max(estimated_value) AS max_estimated_value, round(sum(engagement_score), 6) AS total_engagement_score,
      round(avg(engagement_score), 6) AS avg_engagement_score, round(avg(popularity), 6) AS avg_popularity,
      CAST(sum(content_length) AS BIGINT) AS total_content_length, median(content_length) AS median_content_length
    FROM measured GROUP BY primary_category""",
)
def _(spark, sf):
    out = agg.category_summary(measured(spark, sf))
    out = rounded(out, 4, "avg_rating_score", "avg_estimated_value", "median_estimated_value")
    return rounded(rounded(out, 2, "total_estimated_value"), 6, "total_engagement_score", "avg_engagement_score", "avg_popularity")


@query(
    "document_type_summary", 49,
    sql=f"""WITH {RATED_SQL}, z AS (SELECT *, coalesce(rating_score, 0) AS r FROM rated)
    SELECT document_type, count(record_id) AS article_count, round(avg(r), 6) AS avg_rating_score, median(r) AS median_rating_score,
      0.0::DOUBLE AS total_estimated_value, 0.0::DOUBLE AS avg_estimated_value, 0.0::DOUBLE AS total_engagement_score,
      round(avg(content_length), 4) AS avg_content_length FROM z GROUP BY document_type""",
)
def _(spark, sf):
    return rounded(rounded(agg.document_type_summary(rated(spark, sf)), 6, "avg_rating_score"), 4, "avg_content_length")


@query(
    "yearly_summary", 50,
    sql=f"""WITH {DATED_SQL} SELECT analysis_year, count(record_id) AS article_count, round(avg(rating_score), 6) AS avg_rating_score,
      round(median(rating_score), 6) AS median_rating_score, round(sum(estimated_value), 2) AS total_estimated_value,
      round(avg(estimated_value), 4) AS avg_estimated_value, round(sum(engagement_score), 2) AS total_engagement_score,
      CAST(sum(content_length) AS BIGINT) AS total_content_length
    FROM dated WHERE analysis_year BETWEEN 1996 AND 2000 GROUP BY analysis_year""",
)
def _(spark, sf):
    out = agg.yearly_summary(dated(spark, sf), first=1996, last=2000)
    out = rounded(out, 6, "avg_rating_score", "median_rating_score")
    return rounded(rounded(out, 2, "total_estimated_value", "total_engagement_score"), 4, "avg_estimated_value")


@query(
    "store_category_groups", 52,
    sql="""SELECT source AS category, count(*) AS record_count, count(*) FILTER (text <> '') AS titles_available,
      count(*) FILTER (text <> '') AS text_records_available, count(DISTINCT lang) AS unique_document_type_count,
      arg_min('feed ' || source, doc_id) AS sample_source FROM documents GROUP BY source""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("category"), F.col("lang").alias("document_type"), F.concat(F.lit("feed "), "source").alias("source"), F.col("text").alias("name"), "text"
    )
    return agg.store_category_groups(docs, "doc_id")


@query(
    "store_type_groups", 53,
    sql="""SELECT lang AS document_type, count(*) AS record_count, count(quality) AS titles_available
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""",
)
def _(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("title"))
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("document_type"))
    return agg.store_type_groups(docs.join(labels, "doc_id", "left"))


@query("store_source_groups", 54, sql="SELECT source AS source_name, count(*) AS record_count FROM documents GROUP BY source")
def _(spark, sf):
    return agg.store_source_groups(articles(spark, sf))


@query(
    "global_mean", 55,
    sql=f"WITH {RATED_SQL} SELECT round(avg(rating_score), 6) AS global_mean, count(*) AS total_rows, count(rating_score) AS rating_count FROM rated",
)
def _(spark, sf):
    return rounded(agg.global_mean(rated(spark, sf)), 6, "global_mean")


@query(
    "mean_by_language", 55,
    sql=f"""WITH {RATED_SQL} SELECT language, round(avg(rating_score), 6) AS mean_rating_score, count(rating_score) AS record_count
    FROM rated WHERE rating_score IS NOT NULL GROUP BY language""",
)
def _(spark, sf):
    return rounded(agg.mean_by_group(rated(spark, sf)), 6, "mean_rating_score")


@query(
    "kpi_row", 56, 104,
    sql=f"""WITH {RATED_SQL} SELECT count(*) AS total_records, count(DISTINCT category) AS category_count, count(DISTINCT document_type) AS document_type_count,
      round_even(avg(coalesce(rating_score, 0)), 2) AS avg_rating, round_even(avg(popularity), 2) AS avg_popularity,
      round_even(avg(content_length), 2) AS avg_content_length FROM rated""",
)
def _(spark, sf):
    return agg.kpi_row(clean.dashboard_rows(rated(spark, sf)))


@query(
    "value_counts", 57,
    sql=f"""WITH {RATED_SQL}, tall AS (
      SELECT 'language' AS "column", language AS value FROM rated UNION ALL SELECT 'category', category FROM rated
      UNION ALL SELECT 'rating_score', CAST(rating_score AS VARCHAR) FROM rated),
    c AS (SELECT "column", value, count(*) AS "count" FROM tall GROUP BY 1, 2)
    SELECT "column", value, "count", CAST(row_number() OVER (PARTITION BY "column" ORDER BY "count" DESC, value NULLS LAST) AS INTEGER) AS rank,
      count(value) OVER (PARTITION BY "column") AS nunique
    FROM c QUALIFY rank <= 15""",
)
def _(spark, sf):
    return agg.value_counts(rated(spark, sf), ["language", "category", "rating_score"])


@query(
    "distinct_counts", 58,
    sql="""SELECT 'o_orderkey' AS "column", count(DISTINCT o_orderkey) AS nunique, 'bigint' AS dtype FROM orders
    UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey), 'bigint' FROM orders
    UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus), 'string' FROM orders
    UNION ALL SELECT 'o_totalprice', count(DISTINCT o_totalprice), 'double' FROM orders
    UNION ALL SELECT 'o_orderdate', count(DISTINCT o_orderdate), 'timestamp_ntz' FROM orders
    UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority), 'string' FROM orders""",
)
def _(spark, sf):
    return agg.distinct_counts(table(spark, sf, "orders"))


def _describe_sql(source: str, name: str) -> str:
    return f"""SELECT '{name}' AS "column", count({name}) AS "count", round(avg({name}), 4) AS mean, round(stddev_samp({name}), 4) AS std,
      CAST(min({name}) AS DOUBLE) AS min, round(quantile_cont({name}, 0.25), 4) AS q1, round(quantile_cont({name}, 0.5), 4) AS median,
      round(quantile_cont({name}, 0.75), 4) AS q3, CAST(max({name}) AS DOUBLE) AS max FROM {source}"""


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("describe_numbers", 59, sql=" UNION ALL ".join(_describe_sql("lineitem", n) for n in _MEASURES))
def _(spark, sf):
    return rounded(agg.describe_numbers(table(spark, sf, "lineitem"), _MEASURES), 4, "mean", "std", "q1", "median", "q3")


def _describe_text_sql(name: str) -> str:
    return f"""SELECT '{name}' AS "column", CAST(sum(c) AS BIGINT) AS "count", NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS q1,
      NULL::DOUBLE AS median, NULL::DOUBLE AS q3, NULL::DOUBLE AS max, count(*) AS "unique", (array_agg(v ORDER BY c DESC, v))[1] AS top, max(c) AS freq
    FROM (SELECT {name} AS v, count(*) AS c FROM orders WHERE {name} IS NOT NULL GROUP BY 1)"""


@query(
    "describe_all", 60,
    sql=" UNION ALL ".join(
        [
            *[f"SELECT *, NULL::BIGINT AS \"unique\", NULL::VARCHAR AS top, NULL::BIGINT AS freq FROM ({_describe_sql('orders', n)})" for n in ("o_custkey", "o_totalprice")],
            *[_describe_text_sql(n) for n in ("o_orderstatus", "o_orderpriority")],
        ]
    ),
)
def _(spark, sf):
    out = agg.describe_all(table(spark, sf, "orders"), ["o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"])
    return rounded(out, 4, "mean", "std", "q1", "median", "q3")


@query(
    "shape", 61,
    sql="""SELECT count(*) AS "rows", 6::BIGINT AS "columns", count(*) * 6 AS cells,
    'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority' AS column_names FROM orders""",
)
def _(spark, sf):
    return agg.shape(table(spark, sf, "orders"))


@query(
    "weighted_ratings", 62,
    sql="""SELECT l_orderkey, l_linenumber, l_quantity / 5 * 10 AS normalised, round_even(l_quantity / 5 * ln(1 + l_suppkey), 2) AS weighted,
    l_quantity / 5 > 7.5 AS high_rated, l_quantity / 5 > 7.0 AND l_suppkey > 20 AS high_impact FROM lineitem""",
)
def _(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 5).alias("rating"), F.col("l_suppkey").alias("mentions"))
    return agg.weighted_ratings(items, "rating", "mentions").drop("rating", "mentions")


@query(
    "rating_stats", 62,
    sql="""SELECT round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std, max(l_quantity) AS max,
    min(l_suppkey) AS min_mentions, CAST(sum(l_suppkey) AS BIGINT) AS total_mentions FROM lineitem""",
)
def _(spark, sf):
    return rounded(agg.rating_stats(table(spark, sf, "lineitem"), "l_quantity", "l_suppkey"), 6, "mean", "std")


@query(
    "column_reductions", 63,
    sql=" UNION ALL ".join(f"SELECT '{n}' AS \"column\", round(avg({n}), 6) AS mean, round(stddev_pop({n}), 6) AS std FROM lineitem" for n in _MEASURES),
)
def _(spark, sf):
    return rounded(agg.column_reductions(table(spark, sf, "lineitem"), _MEASURES), 6, "mean", "std")


@query("row_means", 63, sql="SELECT l_orderkey, l_linenumber, round((l_quantity + l_discount + l_tax) / 3, 6) AS row_mean FROM lineitem")
def _(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return rounded(agg.row_means(items, ["l_quantity", "l_discount", "l_tax"]), 6, "row_mean").select("l_orderkey", "l_linenumber", "row_mean")


_CORR = ["rating_score", "popularity", "content_length", "mentions"]


@query(
    "correlations", 64,
    sql=f"WITH {RATED_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM rated"
        for a, b in [*[(n, n) for n in _CORR], *combinations(_CORR, 2), *[(b, a) for a, b in combinations(_CORR, 2)]]
    ),
)
def _(spark, sf):
    return rounded(agg.correlations(rated(spark, sf), _CORR), 6, "corr")


def _histogram_sql(source: str, value: str, bins: int, group: str = "") -> str:
    g = f"{group}, " if group else ""
    return f"""SELECT {g}bin, lo + bin * ((hi - lo) / {bins}) AS bin_start, lo + (bin + 1) * ((hi - lo) / {bins}) AS bin_end, count(*) AS "count" FROM (
      SELECT {g}lo, hi, CAST(least(floor(({value} - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INTEGER) AS bin
      FROM {source}, (SELECT min({value}) AS lo, max({value}) AS hi FROM {source}) WHERE {value} IS NOT NULL) GROUP BY {g}lo, hi, bin"""


@query("histogram", 65, sql=_histogram_sql("lineitem", "l_extendedprice", 25))
def _(spark, sf):
    return agg.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 25)


@query("histogram_by_language", 65, sql=f"WITH {RATED_SQL} {_histogram_sql('rated', 'popularity', 30, 'language')}")
def _(spark, sf):
    return agg.histogram(rated(spark, sf), "popularity", 30, ["language"])


@query(
    "box_numbers", 66,
    sql="""WITH top AS (SELECT l_suppkey AS k FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, CAST(l_suppkey AS VARCHAR) LIMIT 8),
    r AS (SELECT CAST(l_suppkey AS VARCHAR) AS l_suppkey, l_extendedprice * l_quantity AS v FROM lineitem WHERE l_suppkey IN (SELECT k FROM top)),
    q AS (SELECT l_suppkey, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS m, quantile_cont(v, 0.75) AS q3 FROM r GROUP BY 1)
    SELECT l_suppkey, any_value(n) AS n, round(any_value(q1), 4) AS q1, round(any_value(m), 4) AS median, round(any_value(q3), 4) AS q3,
      round(min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_low,
      round(max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_high,
      count(*) FILTER (v NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
    FROM r JOIN q USING (l_suppkey) GROUP BY l_suppkey""",
)
def _(spark, sf):
    items = table(spark, sf, "lineitem").select("l_suppkey", (F.col("l_extendedprice") * F.col("l_quantity")).alias("v"))
    return rounded(agg.box_numbers(items, "v", "l_suppkey"), 4, "q1", "median", "q3", "whisker_low", "whisker_high")


@query(
    "bar_data", 67,
    sql=f"""WITH {DATED_SQL} SELECT document_type, count(record_id) AS record_count, round(avg(rating_score), 6) AS avg_rating,
    round(avg(popularity), 4) AS avg_popularity, round(avg(content_length), 4) AS avg_content_length
    FROM dated GROUP BY 1 ORDER BY record_count DESC, document_type LIMIT 10""",
)
def _(spark, sf):
    means = {"rating_score": "avg_rating", "popularity": "avg_popularity", "content_length": "avg_content_length"}
    return rounded(rounded(agg.bar_data(dated(spark, sf), "document_type", means), 6, "avg_rating"), 4, "avg_popularity", "avg_content_length")


@query(
    "yearly_chart", 67,
    sql=f"""WITH {DATED_SQL} SELECT analysis_year, count(record_id) AS record_count, round(avg(rating_score), 6) AS avg_rating,
    round(avg(popularity), 4) AS avg_popularity FROM dated WHERE analysis_year > 0 GROUP BY 1""",
)
def _(spark, sf):
    out = agg.yearly_chart(dated(spark, sf), "analysis_year", {"rating_score": "avg_rating", "popularity": "avg_popularity"})
    return rounded(rounded(out, 6, "avg_rating"), 4, "avg_popularity")


@query(
    "scatter_data", 68,
    sql=f"""WITH {RATED_SQL} SELECT record_id, category, content_length, popularity, rating_score,
    least(greatest(rating_score, 0.2), 10.0) AS marker_size FROM rated WHERE rating_score IS NOT NULL""",
)
def _(spark, sf):
    return agg.scatter_data(rated(spark, sf), "content_length", "popularity", "rating_score", ["record_id", "category"])


@query(
    "scatter_top_groups", 68,
    sql=f"""WITH {RATED_SQL}, top AS (SELECT category FROM rated GROUP BY 1 ORDER BY count(*) DESC, category LIMIT 8)
    SELECT category, record_id, content_length, popularity FROM rated WHERE category IN (SELECT category FROM top)""",
)
def _(spark, sf):
    top = agg.in_top_groups(rated(spark, sf), "category", 8)
    return agg.scatter_data(top, "content_length", "popularity", keep=["category", "record_id"])


_DASH_SQL = f"""{RATED_SQL}, dash AS (SELECT * REPLACE (coalesce(rating_score, 0) AS rating_score), 0 AS published_year FROM rated)"""


@query(
    "dashboard_panels", 69,
    sql=f"""WITH {_DASH_SQL}, f AS (SELECT * FROM dash WHERE document_type IN ('doc_en', 'doc_de')),
    h AS (SELECT DISTINCT category, least(floor((rating_score - lo) / ((hi - lo) / 30)), 29) AS b FROM f, (SELECT min(rating_score) AS lo, max(rating_score) AS hi FROM f))
    SELECT 'kpis' AS panel, 1::BIGINT AS "rows" UNION ALL SELECT 'top_records', least(12, count(*)) FROM f UNION ALL SELECT 'rating_histogram', count(*) FROM h
    UNION ALL SELECT 'popularity_points', count(*) FROM f UNION ALL SELECT 'categories', least(10, count(DISTINCT category)) FROM f
    UNION ALL SELECT 'document_types', least(12, count(DISTINCT document_type)) FROM f UNION ALL SELECT 'years', 0::BIGINT
    UNION ALL SELECT 'rating_box', least(8, count(DISTINCT category)) FROM f""",
)
def _(spark, sf):
    return dashboard.panel_sizes(clean.dashboard_rows(rated(spark, sf)), document_types=["doc_en", "doc_de"])


_INSIGHT_SQL = f"""WITH {DATED_SQL}, p AS (SELECT *, lower(trim(primary_category)) AS c, lower(document_type) AS t FROM dated),
cat AS (SELECT c, count(record_id) AS n, sum(estimated_value) AS total, avg(rating_score) AS r FROM p GROUP BY c),
typ AS (SELECT t, count(*) AS n FROM p GROUP BY t), yr AS (SELECT analysis_year AS y, count(*) AS n FROM p GROUP BY 1)
SELECT * FROM (SELECT '{insights.Q_VALUE}' AS question, printf('{insights.A_VALUE.replace("'", "''")}', c, total, n) AS answer,
  'total_estimated_value' AS main_metric, round_even(total, 2) AS metric_value, n AS supporting_count FROM cat ORDER BY total DESC, c LIMIT 1)
UNION ALL SELECT * FROM (SELECT '{insights.Q_RATING}', printf('{insights.A_RATING.replace("'", "''")}', c, r), 'avg_rating_score', round_even(r, 2), n FROM cat ORDER BY r DESC, c LIMIT 1)
UNION ALL SELECT * FROM (SELECT '{insights.Q_TYPE}', printf('{insights.A_TYPE.replace("'", "''")}', t, n), 'article_count', n::DOUBLE, n FROM typ ORDER BY n DESC, t LIMIT 1)
UNION ALL SELECT * FROM (SELECT '{insights.Q_RECORD}', printf('{insights.A_RECORD.replace("'", "''")}', title, CAST(record_id AS VARCHAR), estimated_value), 'estimated_value', round_even(estimated_value, 2), 1::BIGINT
  FROM p ORDER BY estimated_value DESC, record_id LIMIT 1)
UNION ALL SELECT * FROM (SELECT '{insights.Q_YEAR}', printf('{insights.A_YEAR}', y, n), 'article_count_by_year', n::DOUBLE, n FROM yr ORDER BY n DESC, y LIMIT 1)
UNION ALL SELECT '{insights.Q_LEADERS}', printf('{insights.A_LEADERS}', count(*)), 'top_records_per_category', count(*)::DOUBLE, count(*) FROM cat"""


@query("insight_questions", 70, sql=_INSIGHT_SQL)
def _(spark, sf):
    return insights.questions(clean.insight_rows(dated(spark, sf).drop("analysis_year")))


@query(
    "insight_rows", 71,
    sql=f"""WITH {RATED_SQL} SELECT record_id, lower(category) AS primary_category, NULL::INTEGER AS analysis_year, coalesce(rating_score, 0) AS rating_score,
      popularity, content_length, 0.0::DOUBLE AS estimated_value, document_type AS analysis_document_type,
      CASE WHEN trim(title) = '' THEN 'Untitled Record' ELSE trim(title) END AS analysis_title FROM rated""",
)
def _(spark, sf):
    names = ["primary_category", "analysis_year", "rating_score", "popularity", "content_length", "estimated_value", "analysis_document_type", "analysis_title"]
    return clean.insight_rows(rated(spark, sf)).select("record_id", *names)


@query(
    "top_per_group", 72,
    sql="""SELECT o_orderkey, o_custkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""",
)
def _(spark, sf):
    return top_per_group(table(spark, sf, "orders"), "o_custkey", "o_totalprice", "o_orderkey", keep=[])


@query(
    "lowest_per_group", 72,
    sql=f"""WITH {RATED_SQL} SELECT record_id, language, coalesce(rating_score, 0) AS rating_score, category FROM rated
    QUALIFY row_number() OVER (PARTITION BY language ORDER BY coalesce(rating_score, 0), record_id) <= 5""",
)
def _(spark, sf):
    return top_per_group(rated(spark, sf), "language", "rating_score", "record_id", 5, ascending=True, keep=["category"])


@query(
    "top_records", 73,
    sql=f"""WITH {_DASH_SQL} SELECT record_id, title, category, popularity, rating_score,
      CASE WHEN length(title) > 70 THEN left(title, 70) || '...' ELSE title END AS title_short,
      CASE WHEN length(title) > 95 THEN left(title, 95) || '...' ELSE title END AS title_cell, left(title, 35) AS title_bar
    FROM (SELECT * REPLACE (coalesce(nullif(trim(title), ''), 'Untitled') AS title) FROM dash) ORDER BY popularity DESC, rating_score DESC, record_id LIMIT 12""",
)
def _(spark, sf):
    return dashboard.top_records(clean.dashboard_rows(rated(spark, sf)), 12)


@query(
    "top_customers", 74,
    sql="""SELECT o_custkey AS primary_category, round(sum(o_totalprice), 2) AS total_estimated_value, count(*) AS article_count
    FROM orders GROUP BY 1 ORDER BY total_estimated_value DESC, primary_category LIMIT 10""",
)
def _(spark, sf):
    totals = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("primary_category")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("total_estimated_value"), F.count(F.lit(1)).alias("article_count")
    )
    return agg.top_of(totals, "total_estimated_value", "primary_category")


@query(
    "scaled", 76,
    sql="""SELECT l_orderkey, l_linenumber, round((l_extendedprice - lo) / (hi - lo), 8) AS scaled
    FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)""",
)
def _(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rounded(agg.scaled(items, "l_extendedprice"), 8, "scaled").drop("l_extendedprice")
