"""Melt, pivots, crosstabs, label counts, time series."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsmill.functions.dates import decade, parsed
from newsmill.operators import reshape
from newsmill.operators import timeseries as ts
from newsmill.plans.registry import query
from newsmill.plans.stand_ins import DATED_SQL, RATED_SQL, articles, dated, rated, rounded
from newsmill.session import table

_METRICS = ["popularity", "engagement_score", "estimated_value", "rating_score", "content_length"]
_MELT_SQL = " UNION ALL ".join(f"SELECT record_id, title, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM dated" for m in _METRICS)


@query("melt_metrics", 79, sql=f"WITH {DATED_SQL} {_MELT_SQL}")
def _(spark, sf):
    return reshape.melt_metrics(dated(spark, sf), ["record_id", "title"])


@query(
    "melt_with_gaps", 79,
    sql=f"""WITH {RATED_SQL} SELECT record_id, 'rating_score' AS metric, rating_score AS value FROM rated
    UNION ALL SELECT record_id, 'mentions', mentions FROM rated UNION ALL SELECT record_id, 'popularity', popularity FROM rated""",
)
def _(spark, sf):
    return reshape.melt(rated(spark, sf), ["record_id"], ["rating_score", "mentions", "popularity"])


@query("widen_unique", 80, sql="SELECT o_orderkey AS record_id, o_totalprice AS price, CAST(o_custkey AS DOUBLE) AS customer FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("record_id"), F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("customer"))
    tall = reshape.melt(orders, ["record_id"], ["price", "customer"])
    return reshape.widen(tall, "record_id", "metric", "value", ["price", "customer"])


@query(
    "widen_mean", 81,
    sql="""SELECT l_suppkey, l_returnflag, round(avg(l_quantity), 6) AS quantity, round(avg(l_discount), 6) AS discount FROM lineitem GROUP BY ALL""",
)
def _(spark, sf):
    items = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"))
    tall = reshape.melt(items, ["l_suppkey", "l_returnflag"], ["quantity", "discount"])
    return rounded(reshape.widen_mean(tall, ["l_suppkey", "l_returnflag"], values=["quantity", "discount"]), 6, "quantity", "discount")


def _margin_sql(cell: str, index: str, column: str, values: list[str], source: str, places: int | None) -> str:
    def one(condition: str) -> str:
        body = f"{cell} FILTER ({condition})" if condition else cell
        return f"coalesce(round({body}, {places}), 0)" if places is not None else f"coalesce({body}, 0)"

    cells = ", ".join(f"{one(f'{column} = {v!r}')} AS \"{v}\"" for v in values)
    tail = f"{cells}, {one('')} AS \"All\" FROM {source}"
    return f"SELECT CAST({index} AS VARCHAR) AS {index}, {tail} GROUP BY {index} UNION ALL SELECT 'All', {tail}"


@query(
    "pivot_year_status", 82,
    sql=f"WITH {DATED_SQL} " + _margin_sql("avg(estimated_value)", "analysis_year", "document_type", ["F", "O", "P"], "dated", 4),
)
def _(spark, sf):
    out = reshape.pivot_table(dated(spark, sf), "estimated_value", "analysis_year", "document_type", margins=True, values=["F", "O", "P"])
    return rounded(out, 4, "F", "O", "P", "All")


@query(
    "pivot_source_language_with_gaps", 82,
    sql=f"WITH {RATED_SQL}, known AS (SELECT * FROM rated WHERE rating_score IS NOT NULL) "
    + _margin_sql("avg(rating_score)", "category", "language", ["de", "en", "es", "fr"], "known", 6),
)
def _(spark, sf):
    out = reshape.pivot_table(rated(spark, sf), "rating_score", "category", "language", margins=True)
    return rounded(out, 6, "de", "en", "es", "fr", "All")


@query(
    "pivot_sum", 82,
    sql="""SELECT l_returnflag, round(coalesce(sum(l_quantity) FILTER (l_linestatus = 'F'), 0), 2) AS "F",
    round(coalesce(sum(l_quantity) FILTER (l_linestatus = 'O'), 0), 2) AS "O" FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    out = reshape.pivot_table(table(spark, sf, "lineitem"), "l_quantity", "l_returnflag", "l_linestatus", "sum", values=["F", "O"])
    return rounded(out, 2, "F", "O")


@query("crosstab_status_decade", 83, sql=f"WITH {DATED_SQL}, x AS (SELECT *, (analysis_year // 10 * 10) || 's' AS decade FROM dated) " + _margin_sql("count(*)", "document_type", "decade", ["1990s", "2000s"], "x", None))
def _(spark, sf):
    return reshape.crosstab(dated(spark, sf).withColumn("decade", decade(F.col("analysis_year"))), "document_type", "decade")


@query(
    "crosstab_shares", 83,
    sql="""SELECT o_orderstatus, round(count(*) FILTER (o_orderpriority = '1-URGENT') / count(*), 6) AS "1-URGENT",
      round(count(*) FILTER (o_orderpriority = '5-LOW') / count(*), 6) AS "5-LOW" FROM orders GROUP BY 1
    UNION ALL SELECT 'All', round(count(*) FILTER (o_orderpriority = '1-URGENT') / count(*), 6), round(count(*) FILTER (o_orderpriority = '5-LOW') / count(*), 6) FROM orders""",
)
def _(spark, sf):
    out = reshape.crosstab(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", "index")
    return rounded(out, 6, "1-URGENT", "5-LOW").select("o_orderstatus", "1-URGENT", "5-LOW")


@query(
    "crosstab_total_shares", 83,
    sql="""WITH t AS (SELECT count(*) AS n FROM documents) SELECT source, round(count(*) FILTER (lang = 'en') / any_value(n), 6) AS en, round(count(*) / any_value(n), 6) AS "All" FROM documents, t GROUP BY 1
    UNION ALL SELECT 'All', round(count(*) FILTER (lang = 'en') / any_value(n), 6), round(count(*) / any_value(n), 6) FROM documents, t""",
)
def _(spark, sf):
    out = reshape.crosstab(table(spark, sf, "documents"), "source", "lang", "all", ["de", "en", "es", "fr"])
    return rounded(out, 6, "en", "All").select("source", "en", "All")


@query(
    "label_counts", 84,
    sql="""SELECT label, count(*) AS "count" FROM (
      SELECT unnest(CASE WHEN p_size % 2 = 0 THEN [p_type, p_brand] ELSE list_transform(regexp_extract_all(p_name, '[A-Za-z][A-Za-z\\s&\\-]+'), lambda x: trim(x)) END) AS label FROM part)
    GROUP BY label ORDER BY "count" DESC, label LIMIT 15""",
)
def _(spark, sf):
    listed = F.concat(F.lit("['"), "p_type", F.lit("', '"), "p_brand", F.lit("']"))
    part = table(spark, sf, "part").select(F.when(F.col("p_size") % 2 == 0, listed).otherwise(F.col("p_name")).alias("category"))
    return reshape.label_counts(part)


@query("json_label_counts", 84, sql="""SELECT event_type AS label, count(*) AS "count" FROM events GROUP BY 1""")
def _(spark, sf):
    events = table(spark, sf, "events")
    named = F.concat(F.lit('[{"id": 1, "name" : "'), "event_type", F.lit('"}]'))
    return reshape.label_counts(events.select(named.alias("genres")), top=None)


def _series_sql(unit: str, extra: str = "", total: str = "round(sum(v), 2)") -> str:
    months = {"month": 1, "quarter": 3, "year": 12}[unit]
    median = ", round(median(v), 4) AS median_estimated_value" if extra else ""
    keep = ", median_estimated_value" if extra else ""
    return f"""r AS (SELECT date_trunc('{unit}', CASE WHEN month(o_orderdate) IN (4, 5, 6) THEN o_orderdate + INTERVAL 3 MONTH ELSE o_orderdate END)::DATE AS p, o_totalprice / 997 AS v FROM orders),
    t AS (SELECT p, count(*) AS c, {total} AS total_estimated_value, round(avg(v), 4) AS avg_estimated_value{median} FROM r GROUP BY p),
    spine AS (SELECT unnest(generate_series((SELECT min(p) FROM r)::TIMESTAMP, (SELECT max(p) FROM r)::TIMESTAMP, INTERVAL {months} MONTH))::DATE AS p),
    series AS (SELECT last_day((p + INTERVAL {months - 1} MONTH)::DATE) AS analysis_date, coalesce(c, 0) AS article_count,
      coalesce(total_estimated_value, 0) AS total_estimated_value, avg_estimated_value{keep} FROM spine LEFT JOIN t USING (p))"""


def _gappy(spark, sf):
    """All orders; those of the second quarter are moved to the third, which leaves gaps."""
    date = F.col("published_date")
    moved = F.when(F.month(date).isin(4, 5, 6), F.add_months(date, 3).cast("timestamp_ntz")).otherwise(date)
    return dated(spark, sf).withColumn("published_date", moved)


_SUMS = ["total_estimated_value"]


@query("monthly_series", 134, sql=f"WITH {_series_sql('month', 'm')} SELECT * FROM series")
def _(spark, sf):
    return rounded(rounded(ts.monthly(_gappy(spark, sf)), 2, *_SUMS), 4, "avg_estimated_value", "median_estimated_value")


@query("quarterly_series", 135, sql=f"WITH {_series_sql('quarter')} SELECT * FROM series")
def _(spark, sf):
    return rounded(rounded(ts.quarterly(_gappy(spark, sf)), 2, *_SUMS), 4, "avg_estimated_value")


@query("yearly_series", 135, sql=f"WITH {_series_sql('year')} SELECT * FROM series")
def _(spark, sf):
    return rounded(rounded(ts.yearly(_gappy(spark, sf)), 2, *_SUMS), 4, "avg_estimated_value")


@query(
    "rolling_means", 75,
    sql=f"""WITH {_series_sql('month', total='sum(v)')} SELECT analysis_date, article_count, round(total_estimated_value, 2) AS total_estimated_value, """
    + ", ".join(f"round(avg(total_estimated_value) OVER (ORDER BY analysis_date ROWS {w - 1} PRECEDING), 4) AS rolling_{w}_month_avg" for w in (3, 6, 12))
    + " FROM series",
)
def _(spark, sf):
    series = ts.resample(_gappy(spark, sf), "month").drop("avg_estimated_value")
    rolled = ts.with_rolling_means(series, "total_estimated_value")
    return rounded(rounded(rolled, 2, "total_estimated_value"), 4, *[f"rolling_{w}_month_avg" for w in (3, 6, 12)])


@query("dated_articles", 95, sql="""SELECT doc_id AS record_id, TIMESTAMP '2020-01-01' + doc_id % 1000 * INTERVAL 1 DAY AS analysis_date FROM documents WHERE lang <> 'fr' UNION ALL SELECT doc_id, NULL FROM documents WHERE lang = 'fr'""")
def _(spark, sf):
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("record_id") % 1000).cast("int"))
    text = F.when(F.col("language") == "fr", "no date").when(F.col("language") == "en", F.date_format(day, "dd/MM/yyyy")).otherwise(day.cast("string"))
    raw = articles(spark, sf).select("record_id", text.alias("publishedAt"))
    return raw.select("record_id", parsed(raw, "publishedAt", ["dd/MM/yyyy"]).cast("timestamp_ntz").alias("analysis_date"))


@query(
    "date_parts", 96,
    sql="""SELECT o_orderkey AS record_id, CAST(year(o_orderdate) AS INTEGER) AS analysis_year, CAST(month(o_orderdate) AS INTEGER) AS analysis_month, monthname(o_orderdate) AS analysis_month_name,
    CAST(isodow(o_orderdate) - 1 AS INTEGER) AS analysis_weekday, dayname(o_orderdate) AS analysis_weekday_name, CAST(quarter(o_orderdate) AS INTEGER) AS analysis_quarter FROM orders""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("record_id"), F.col("o_orderdate").alias("published_date"))
    return ts.with_date_parts(orders).drop("published_date", "analysis_date")
