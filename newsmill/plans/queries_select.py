"""Filters, facets, joins, set comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsmill.functions.text import CRIME_TERMS, TOPIC_TERMS
from newsmill.operators import joins, select
from newsmill.operators.ordering import every_kth
from newsmill.plans.dashboard import filtered
from newsmill.plans.registry import query
from newsmill.plans.stand_ins import ARTICLES_SQL, DATED_SQL, MEASURED_SQL, RATED_SQL, SQL_WORD, articles, dated, measured, rated, rounded
from newsmill.session import table


def _sql_words(words: list[str]) -> str:
    return f"(?i)(^|[^{SQL_WORD}])({'|'.join(words)})([^{SQL_WORD}]|$)"


@query("select_present", 29, sql=f"WITH {ARTICLES_SQL} SELECT record_id, language, content_length FROM articles")
def _(spark, sf):
    return select.select_present(articles(spark, sf), ["record_id", "language", "no_such_column", "content_length"])


@query("rating_at_least", 30, sql=f"WITH {DATED_SQL} SELECT record_id, title, document_type, rating_score, popularity FROM dated WHERE rating_score >= 7.0")
def _(spark, sf):
    return select.at_least(dated(spark, sf), 7.0)


@query(
    "every_tenth_order", 31,
    sql="SELECT o_orderkey, o_custkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS p FROM orders) WHERE p % 10 = 0",
)
def _(spark, sf):
    return every_kth(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 10)


@query(
    "rated_and_mentioned", 32,
    sql=f"WITH {RATED_SQL} SELECT record_id, rating_score, mentions, popularity FROM rated WHERE rating_score > 5 AND coalesce(mentions, 0) >= 1 AND coalesce(popularity, 0) > 10",
)
def _(spark, sf):
    return select.rated_and_mentioned(rated(spark, sf)).select("record_id", "rating_score", "mentions", "popularity")


@query("language_in", 33, sql=f"WITH {ARTICLES_SQL} SELECT record_id, language FROM articles WHERE language IN ('en', 'unknown')")
def _(spark, sf):
    return select.in_values(articles(spark, sf)).select("record_id", "language")


@query("rating_not_in", 33, sql=f"WITH {RATED_SQL} SELECT record_id, rating_score FROM rated WHERE rating_score IS NULL OR rating_score NOT IN (7, 9)")
def _(spark, sf):
    return select.in_values(rated(spark, sf), ["7.0", "9.0"], "rating_score", exclude=True).select("record_id", "rating_score")


@query("rating_between", 34, sql=f"WITH {DATED_SQL} SELECT record_id, rating_score FROM dated WHERE rating_score BETWEEN 2 AND 8")
def _(spark, sf):
    return select.between(dated(spark, sf)).select("record_id", "rating_score")


@query("title_prefix", 35, sql=rf"WITH {ARTICLES_SQL} SELECT record_id, title FROM articles WHERE regexp_matches(title, '(?i)^The([^{SQL_WORD}]|$)')")
def _(spark, sf):
    return select.starts_with(articles(spark, sf), "The").select("record_id", "title")


@query(
    "topic_rows", 36,
    sql=f"WITH {ARTICLES_SQL} SELECT record_id, title, content_text, category, document_type, source_name FROM articles WHERE regexp_matches(content_text, '{_sql_words(TOPIC_TERMS)}')",
)
def _(spark, sf):
    return select.topic_rows(articles(spark, sf))


@query(
    "crime_rows", 36,
    sql=f"""WITH {ARTICLES_SQL}, a AS (SELECT * REPLACE (CASE WHEN record_id % 4 = 0 THEN content_text || ' The Murder, they said.' WHEN record_id % 4 = 1 THEN content_text || ' murderously' ELSE content_text END AS content_text) FROM articles)
    SELECT record_id, title, content_text, category, document_type, source_name FROM a WHERE regexp_matches(content_text, '{_sql_words(CRIME_TERMS)}')""",
)
def _(spark, sf):
    body, turn = F.col("content_text"), F.col("record_id") % 4
    told = F.when(turn == 0, F.concat(body, F.lit(" The Murder, they said."))).when(turn == 1, F.concat(body, F.lit(" murderously"))).otherwise(body)
    return select.crime_rows(articles(spark, sf).withColumn("content_text", told))


@query(
    "term_counts", 36,
    sql=f"SELECT count(*) FILTER (regexp_matches(text, '{_sql_words(TOPIC_TERMS)}')) AS topic_count, count(*) FILTER (regexp_matches(text, '{_sql_words(CRIME_TERMS)}')) AS crime_count FROM documents",
)
def _(spark, sf):
    return select.term_counts(articles(spark, sf))


@query("word_rows", 36, sql=f"WITH {ARTICLES_SQL} SELECT record_id FROM articles WHERE regexp_matches(content_text, '{_sql_words(['avec', 'thing'])}')")
def _(spark, sf):
    return select.with_terms(articles(spark, sf), ["avec", "thing"]).select("record_id")


@query("short_texts", 37, sql=f"WITH {ARTICLES_SQL} SELECT record_id, title, content_text, category, document_type FROM articles WHERE length(content_text) < 40")
def _(spark, sf):
    return select.short_texts(articles(spark, sf))


@query("short_flags", 37, sql=f"WITH {ARTICLES_SQL} SELECT record_id, length(content_text) < 400 AS is_short_content FROM articles")
def _(spark, sf):
    return select.flag_short(articles(spark, sf), limit=400).select("record_id", "is_short_content")


@query(
    "faceted_search", 38,
    sql=f"""WITH {ARTICLES_SQL}, dash AS (SELECT *, 0 AS published_year, content_text AS overview FROM articles)
    SELECT record_id, category, document_type FROM dash
    WHERE category IN ('src1', 'src2', 'src3', 'src4', 'src5') AND document_type IN ('doc_en', 'doc_fr')
      AND (published_year BETWEEN 2000 AND 2020 OR published_year = 0)
      AND contains(lower(title || ' ' || content_text || ' ' || overview || ' ' || category || ' ' || document_type), 'the th')""",
)
def _(spark, sf):
    docs = articles(spark, sf).withColumn("overview", F.col("content_text"))
    facets = {"categories": [f"src{i}" for i in range(1, 6)], "document_types": ["doc_en", "doc_fr"], "years": (2000, 2020), "search": " The th"}
    return filtered(docs, **facets).select("record_id", "category", "document_type")


@query("facet_values", 39, sql="SELECT DISTINCT lang AS language FROM documents")
def _(spark, sf):
    return select.facet_values(articles(spark, sf), "language")


@query("year_range", 39, sql=f"WITH {DATED_SQL} SELECT min(analysis_year) AS first_year, max(analysis_year) AS last_year FROM dated")
def _(spark, sf):
    return select.year_range(dated(spark, sf), "analysis_year")


@query(
    "metadata_filter", 40,
    sql=f"""WITH {DATED_SQL} SELECT record_id, document_type, analysis_year, rating_score FROM dated
    WHERE (document_type = 'F' OR document_type IN ('O')) AND analysis_year >= 1998 AND rating_score < 9 AND rating_score <> 5""",
)
def _(spark, sf):
    where = {
        "$and": [
            {"$or": [{"document_type": {"$eq": "F"}}, {"document_type": {"$in": ["O"]}}]},
            {"analysis_year": {"$gte": 1998}},
            {"rating_score": {"$lt": 9.0, "$ne": 5.0}},
        ]
    }
    return select.matching(dated(spark, sf), where).select("record_id", "document_type", "analysis_year", "rating_score")


@query("without_header_rows", 41, sql="SELECT p_partkey AS record_id, p_name AS title FROM part WHERE trim(p_name) <> ''")
def _(spark, sf):
    # The table as read from stacked files: each brand's part of it begins with a header row.
    part = table(spark, sf, "part")
    rows = part.select(F.col("p_partkey").cast("string").alias("record_id"), F.col("p_name").alias("title"))
    headers = part.select("p_brand").distinct().select(F.lit("record_id").alias("record_id"), F.lit("Title").alias("title"))
    clean = select.without_header_rows(rows.unionByName(headers), ["record_id", "title"], "record_id", "title")
    return clean.select(F.col("record_id").try_cast("bigint").alias("record_id"), "title")


def _join_sides(spark, sf):
    # Keys without a partner on either side, and rows without a key.
    key = F.when(F.col("lang") == "fr", F.col("doc_id") + 1_000_000_000).when(F.col("lang") != "de", F.col("doc_id"))
    docs = table(spark, sf, "documents").select(key.alias("record_id"), F.col("lang").alias("label"), "source")
    labels = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("record_id"), F.col("quality").alias("label"), "toxic")
    return docs, labels


_JOIN_SIDE = "(SELECT * FROM (SELECT * REPLACE (CASE WHEN lang = 'fr' THEN doc_id + 1000000000 WHEN lang <> 'de' THEN doc_id END AS doc_id) FROM documents) WHERE doc_id IS NOT NULL)"
_JOIN_SQL = """SELECT coalesce(d.doc_id, l.doc_id) AS record_id, d.lang AS label_mysql, d.source, l.quality AS label_mongo, l.toxic
FROM {side} d {kind} JOIN labels l ON d.doc_id = l.doc_id"""


def _register_join(kind: str) -> None:
    @query(f"join_{kind}", 42, sql=_JOIN_SQL.format(side=_JOIN_SIDE, kind="FULL OUTER" if kind == "outer" else kind.upper()))
    def _(spark, sf):
        left, right = _join_sides(spark, sf)
        return joins.merge(left, right, "record_id", kind)


for _kind in ("inner", "left", "right", "outer"):
    _register_join(_kind)


@query(
    "order_customer_join", 42,
    sql="""SELECT o_custkey AS record_id, o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("record_id"), "o_orderkey", "o_totalprice")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("record_id"), "c_name", "c_mktsegment")
    return joins.merge(orders, customers)


@query(
    "join_counts", 43,
    sql=f"""WITH d AS {_JOIN_SIDE}
    SELECT 'inner' AS join_type, count(*) AS row_count FROM d JOIN labels USING (doc_id)
    UNION ALL SELECT 'left', count(*) FROM d LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'right', count(*) FROM d RIGHT JOIN labels USING (doc_id)
    UNION ALL SELECT 'outer', count(*) FROM d FULL JOIN labels USING (doc_id)""",
)
def _(spark, sf):
    return joins.join_counts(*_join_sides(spark, sf))


@query(
    "join_counts_repeated_keys", 43,
    sql="""WITH pairs AS (SELECT count(*) AS n FROM lineitem JOIN events ON l_suppkey = user_id),
    lo AS (SELECT count(*) AS n FROM lineitem WHERE l_suppkey NOT IN (SELECT user_id FROM events)),
    ro AS (SELECT count(*) AS n FROM events WHERE user_id NOT IN (SELECT l_suppkey FROM lineitem))
    SELECT t.join_type, CAST(pairs.n + t.l * lo.n + t.r * ro.n AS BIGINT) AS row_count
    FROM pairs, lo, ro, (VALUES ('inner', 0, 0), ('left', 1, 0), ('right', 0, 1), ('outer', 1, 1)) t(join_type, l, r)""",
)
def _(spark, sf):
    left = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("record_id"))
    return joins.join_counts(left, table(spark, sf, "events").select(F.col("user_id").alias("record_id")))


@query(
    "metadata_side", 44,
    sql="""SELECT user_id AS record_id, event_type AS title, CAST(event_id AS VARCHAR) AS url FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    side = events.select(
        F.col("user_id").cast("string").alias("record_id"), F.col("event_type").alias("title"), F.col("event_id").cast("string").alias("url"), "event_id"
    )
    return joins.metadata_side(side, ["event_id"])


@query(
    "group_means", 45,
    sql=f"""WITH {MEASURED_SQL} SELECT record_id, content_length, primary_category,
    round(avg(rating_score) OVER (PARTITION BY primary_category), 4) AS category_avg_rating_score,
    round(avg(estimated_value) OVER (PARTITION BY primary_category), 4) AS category_avg_estimated_value FROM measured""",
)
def _(spark, sf):
    out = joins.with_group_means(measured(spark, sf), "primary_category", ["rating_score", "estimated_value"])
    names = ["category_avg_rating_score", "category_avg_estimated_value"]
    return rounded(out, 4, *names).select("record_id", "content_length", "primary_category", *names)


@query(
    "large_groups", 51,
    sql="SELECT o_orderkey, o_custkey FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey) >= 12",
)
def _(spark, sf):
    return joins.large_groups(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 12)


@query(
    "result_overlap", 47,
    sql="""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O')
    SELECT (SELECT count(*) FROM a JOIN b USING (k)) AS overlap_count,
      round((SELECT count(*) FROM a JOIN b USING (k)) / least((SELECT count(*) FROM a), (SELECT count(*) FROM b)), 6) AS overlap_ratio,
      (SELECT count(*) FROM a) AS set_a_size, (SELECT count(*) FROM b) AS set_b_size""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    a, b = (orders.where(F.col("o_orderstatus") == s) for s in ("F", "O"))
    return rounded(joins.overlap(a, b, "o_custkey", "o_custkey"), 6, "overlap_ratio")


@query("union_by_name", 78, sql="SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    done = orders.where("o_orderstatus = 'F'").select("o_totalprice", "o_orderkey")
    return joins.same_type_union([orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice", "o_orderpriority"), done])
