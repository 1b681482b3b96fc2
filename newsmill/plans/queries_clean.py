"""Text, number and date cleaning, quality reports, deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsmill.functions import text as tx
from newsmill.functions import vectors
from newsmill.operators import clean, dedup, quality
from newsmill.operators.search import metadata, searchable_text
from newsmill.plans import cleaning
from newsmill.plans.normalise import normalise
from newsmill.plans.registry import query
from newsmill.plans.stand_ins import ARTICLES_SQL, RATED_SQL, SQL_WHITE, SQL_WORD, SQL_WS, articles, rated, rounded
from newsmill.session import table


def _trim(e: str) -> str:
    return f"trim({e}, {SQL_WHITE})"


def _collapse(e: str) -> str:
    return f"regexp_replace({e}, '[{SQL_WS}]+', ' ', 'g')"


def _title_sql(e: str) -> str:
    no_year = rf"regexp_replace({_collapse(_trim(e))}, '\(\p{{Nd}}{{4}}\)', '', 'g')"
    return f"coalesce(nullif({_trim(no_year)}, ''), 'Untitled Record')"


def _body_sql(e: str) -> str:
    no_tags = f"regexp_replace({_trim(e)}, '<[^>]+>', ' ', 'g')"
    return f"coalesce(nullif({_trim(_collapse(no_tags))}, ''), 'No content available.')"


def _label_sql(e: str) -> str:
    spaced = f"regexp_replace({_collapse(f'lower({_trim(e)})')}, '[{SQL_WS}]*,[{SQL_WS}]*', ', ', 'g')"
    return f"CASE WHEN {e} IS NULL OR {spaced} IN ('', 'nan', 'none', 'null', 'n/a') THEN 'unknown' ELSE {spaced} END"


# A title as collected: padded, with a year in brackets in every third one.
_RAW_TITLE_SQL = "'  ' || split_part(text, chr(10), 1) || CASE WHEN doc_id % 3 = 0 THEN '   (2026) ' ELSE ' ' END"


def _raw_title():
    tail = F.when(F.col("doc_id") % 3 == 0, "   (2026) ").otherwise(" ")
    return F.concat(F.lit("  "), F.substring_index("text", "\n", 1), tail)


@query("clean_titles", 85, sql=f"SELECT doc_id, {_title_sql('(' + _RAW_TITLE_SQL + ')')} AS title FROM documents")
def _(spark, sf):
    return clean.clean_titles(table(spark, sf, "documents").select("doc_id", _raw_title().alias("title")))


@query(
    "clean_languages", 86,
    sql="""SELECT doc_id, CASE WHEN source IN ('src1', 'src2', 'src3') THEN 'unknown' ELSE lang END AS language,
    CASE WHEN source IN ('src1', 'src2', 'src3') THEN 'unknown' ELSE lang END AS original_language FROM documents""",
)
def _(spark, sf):
    # Three sources give no, a long and a null-like code; the others pad and capitalise it.
    code = F.when(F.col("source") == "src1", F.lit(None)).when(F.col("source") == "src2", F.concat("lang", F.lit("-long")))
    code = code.when(F.col("source") == "src3", F.lit(" NaN ")).otherwise(F.concat(F.lit(" "), F.upper("lang"), F.lit("\t")))
    docs = table(spark, sf, "documents").select("doc_id", code.alias("language"), F.lit("xx").alias("original_language"))
    return clean.clean_languages(docs)


@query("clean_bodies", 87, sql=f"SELECT page_id, {_body_sql('html')} AS content_text, {_body_sql('html')} AS overview FROM pages")
def _(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.col("html").alias("content_text"), F.lit(None).cast("string").alias("overview"))
    return clean.clean_bodies(pages)


@query("clean_labels", 88, sql=f"SELECT p_partkey, {_label_sql('l')} AS category, {_label_sql('l')} AS genres FROM (SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN ' N/A ' WHEN p_type = 'LARGE' THEN NULL ELSE ' ' || p_type || ' ,  ' || p_brand END AS l FROM part)")
def _(spark, sf):
    label = F.when(F.col("p_type") == "PROMO", " N/A ").when(F.col("p_type") != "LARGE", F.concat(F.lit(" "), "p_type", F.lit(" ,  "), "p_brand"))
    return clean.clean_labels(table(spark, sf, "part").select("p_partkey", label.alias("category"), F.lit("old").alias("genres")))


@query(
    "clean_strings", 89, 94,
    sql=f"""SELECT doc_id, {_title_sql('(' + _RAW_TITLE_SQL + ')')} AS title, lang AS language, {_body_sql('text')} AS content_text, lower(source) AS category,
    CASE WHEN lang = 'fr' THEN NULL ELSE 2026 END AS published_year, CASE WHEN lang = 'fr' THEN NULL ELSE 2026 END AS release_year FROM documents""",
)
def _(spark, sf):
    date = F.when(F.col("lang") == "fr", "invalid-date").otherwise("2026-03-01")
    docs = table(spark, sf, "documents").select(
        "doc_id", _raw_title().alias("title"), F.upper("lang").alias("language"), F.col("text").alias("content_text"), F.upper("source").alias("category"), date.alias("published_date")
    )
    return clean.clean_strings(docs).drop("published_date")


_SPACE_SQL = r"regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '\n{2,}', chr(10) || chr(10), 'g')"


@query("normalise_space", 27, sql=f"SELECT doc_id, {_trim(_SPACE_SQL)} AS text FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.normalise_space(F.col("text")).alias("text"))


@query("primary_category", 90, sql="SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'unknown' ELSE lower(p_type) END AS primary_category FROM part")
def _(spark, sf):
    raw = F.when(F.col("p_type") == "PROMO", F.lit(" None ")).otherwise(F.concat(F.col("p_type"), F.lit(" ")))
    return clean.with_primary_category(table(spark, sf, "part").select("p_partkey", raw.alias("genres"))).drop("genres")


@query("analysis_year", 90, 94, sql="SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS analysis_year, CAST(year(o_orderdate) AS INTEGER) AS published_year FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("release_date"), F.lit(None).cast("string").alias("published_date"))
    return clean.with_published_year(clean.with_analysis_year(orders.drop("published_date")).join(orders.drop("release_date"), "o_orderkey")).select("o_orderkey", "analysis_year", "published_year")


@query(
    "article_metrics", 91, 41,
    sql=f"""WITH {RATED_SQL}, m AS (SELECT *, coalesce(rating_score, 0) AS r FROM rated WHERE {_trim('title')} <> '')
    SELECT record_id, title, category AS primary_category, document_type, source_name, NULL::INTEGER AS published_year, r AS rating_score, popularity, content_length,
      0.0::DOUBLE AS title_length, round(r * 10 + popularity * 0.05 + content_length * 0.01, 4) AS engagement_score,
      round((r * 10 + popularity * 0.05 + content_length * 0.01) * (content_length + 1), 5) AS estimated_value FROM m""",
)
def _(spark, sf):
    # Collected twice, the later copies with other numbers: the first row per id counts.
    first = rated(spark, sf).withColumn("seen", F.lit(1))
    later = first.withColumns({"seen": F.lit(2), "popularity": F.lit(1.0)})
    out = clean.article_metrics(first.unionByName(later), ["seen"]).drop("published_date")
    return rounded(rounded(out, 4, "engagement_score"), 5, "estimated_value")


@query(
    "text_numbers", 92,
    sql=rf"""SELECT doc_id, nullif(regexp_extract(text, '\((\p{{Nd}}{{4}})\)', 1), '') AS bracketed_year,
    nullif(regexp_extract(text, '(?:^|[^{SQL_WORD}])((?:19|20)\p{{Nd}}{{2}})(?:[^{SQL_WORD}]|$)', 1), '') AS any_year,
    nullif(regexp_extract(text, '(\p{{Nd}}+)', 1), '') AS first_digits, nullif(regexp_extract(text, '([-+]?\p{{Nd}}*\.?\p{{Nd}}+)', 1), '') AS first_number FROM documents""",
)
def _(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", tx.bracketed_year(t).alias("bracketed_year"), tx.any_year(t).alias("any_year"), tx.first_digits(t).alias("first_digits"), tx.first_number(t).alias("first_number")
    )


@query(
    "url_numbers", 92,
    sql=rf"""SELECT page_id, nullif(regexp_extract(url, '(\p{{Nd}}+)', 1), '') AS title_number, nullif(regexp_extract(url || ' -4.5/10', '([-+]?\p{{Nd}}*\.?\p{{Nd}}+)$', 1), '') AS score FROM pages""",
)
def _(spark, sf):
    score = tx.first_number(F.regexp_extract(F.concat("url", F.lit(" -4.5/10")), "/([^/]*)$", 1))
    return table(spark, sf, "pages").select("page_id", tx.first_digits(F.col("url")).alias("title_number"), score.alias("score"))


@query(
    "valid_ids_and_urls", 93,
    sql=rf"""SELECT page_id, page_id > 0 AS is_valid_news_id, regexp_matches(u, '(?i)^https?://[^{SQL_WS}/$.?#][^\n][^{SQL_WS}]*$') AS is_valid_url
    FROM (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN replace(url, '://', ':/') WHEN page_id % 7 = 0 THEN url || ' x' ELSE '  ' || upper(url) || ' ' END AS r, {_trim('r')} AS u FROM pages)""",
)
def _(spark, sf):
    url = F.when(F.col("page_id") % 5 == 0, F.replace("url", F.lit("://"), F.lit(":/")))
    url = url.when(F.col("page_id") % 7 == 0, F.concat("url", F.lit(" x"))).otherwise(F.concat(F.lit("  "), F.upper("url"), F.lit(" ")))
    pages = table(spark, sf, "pages").select("page_id", url.alias("url"))
    return pages.select("page_id", tx.valid_id(F.col("page_id")).alias("is_valid_news_id"), tx.valid_url(F.col("url")).alias("is_valid_url"))


@query(
    "convert_types", 97,
    sql="""SELECT event_id AS record_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'bad' ELSE json_extract_string(props, '$.k') END AS FLOAT) AS wins,
    CAST(round_even(value, 0) AS BIGINT) AS content_length, CASE WHEN event_type = 'view' THEN NULL ELSE ts END AS fetched_at FROM events""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    wins = F.when(F.col("event_type") == "error", "bad").otherwise(F.get_json_object("props", "$.k"))
    when = F.when(F.col("event_type") == "view", "no date").otherwise(F.col("ts").cast("string"))
    raw = events.select(F.col("event_id").cast("string").alias("record_id"), wins.alias("wins"), F.col("value").cast("string").alias("content_length"), when.alias("fetched_at"))
    out = clean.convert_types(raw)
    return out.withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz"))


@query(
    "type_advice", 98,
    sql="""SELECT 'o_orderkey' AS "column", 'bigint' AS dtype, CASE WHEN max(o_orderkey) < 128 THEN 'tinyint' WHEN max(o_orderkey) < 32768 THEN 'smallint' WHEN max(o_orderkey) < 2147483648 THEN 'int' ELSE 'bigint' END AS advice FROM orders
    UNION ALL SELECT 'o_totalprice', 'double', CASE WHEN bool_and(CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) = o_totalprice) THEN 'float' ELSE 'double' END FROM orders
    UNION ALL SELECT 'o_orderpriority', 'string', CASE WHEN count(DISTINCT o_orderpriority) < 0.5 * count(*) THEN 'dictionary' ELSE 'string' END FROM orders""",
)
def _(spark, sf):
    return clean.type_advice(table(spark, sf, "orders"), ["o_orderkey", "o_totalprice", "o_orderpriority"])


@query(
    "dashboard_rows", 99,
    sql=f"""WITH {RATED_SQL} SELECT record_id, coalesce(nullif({_trim('title')}, ''), 'Untitled') AS title, category, language, 0 AS published_year,
    coalesce(rating_score, 0) AS rating_score, length(coalesce(nullif({_trim('title')}, ''), 'Untitled'))::INTEGER AS title_length, NULL::DOUBLE AS vote_count FROM rated""",
)
def _(spark, sf):
    out = clean.dashboard_rows(rated(spark, sf)).withColumn("title_length", F.col("title_length").cast("int"))
    return out.select("record_id", "title", "category", "language", "published_year", "rating_score", "title_length", "vote_count")


def _part_sql(label: str, e: str) -> str:
    return f"CASE WHEN {_trim(e)} <> '' THEN '{label}' || {_trim(e)} END"


_DOCUMENT_SQL = f"""concat_ws(' | ', {_part_sql('Title: ', 'title')}, {_part_sql('Content: ', 'content_text')}, {_part_sql('Category: ', 'category')},
{_part_sql('Document type: ', 'document_type')}, {_part_sql('Source: ', 'source_name')}, {_part_sql('Language: ', 'language')})"""


@query("searchable_text", 100, sql=f"WITH {ARTICLES_SQL} SELECT record_id, {_DOCUMENT_SQL} AS document FROM articles")
def _(spark, sf):
    docs = articles(spark, sf).withColumn("genres", F.col("category"))
    return docs.select("record_id", searchable_text(docs).alias("document"))


@query(
    "index_metadata", 101,
    sql=f"""WITH {RATED_SQL} SELECT 'record_' || record_id AS id, {_DOCUMENT_SQL} AS document, left(title, 500) AS title, left(category, 100) AS category, left(document_type, 100) AS document_type,
    left(source_name, 200) AS source_name, left(language, 20) AS language, 0 AS year, coalesce(rating_score, 0) AS rating_score, popularity, CAST(content_length AS INTEGER) AS content_length FROM rated""",
)
def _(spark, sf):
    return metadata(rated(spark, sf))


@query(
    "vector_measures", 102,
    sql="""WITH a AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), b AS (SELECT label, arg_min(embedding, vec_id)::DOUBLE[] AS w FROM embeddings GROUP BY label)
    SELECT vec_id, round(list_cosine_similarity(v, w), 6) AS cosine_similarity, round(list_dot_product(v, w), 6) AS dot_product, round(list_distance(v, w), 6) AS euclidean_distance FROM a JOIN b USING (label)""",
)
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    first = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("w"))
    v, w = F.col("embedding"), F.col("w")
    return e.join(first, "label").select(
        "vec_id", F.round(vectors.cosine(v, w), 6).alias("cosine_similarity"), F.round(vectors.dot(v, w), 6).alias("dot_product"), F.round(vectors.euclidean(v, w), 6).alias("euclidean_distance")
    )


_SEVERITY_SQL = "CASE WHEN pct > 30 THEN 'HIGH' WHEN pct > 10 THEN 'MEDIUM' ELSE 'LOW' END"


@query(
    "missing_report", 103, 104,
    sql=f"""WITH {RATED_SQL}, c AS (SELECT 'rating_score' AS "column", count(*) FILTER (rating_score IS NULL) AS k, count(*) AS n, 'double' AS dtype FROM rated
      UNION ALL SELECT 'mentions', count(*) FILTER (mentions IS NULL), count(*), 'double' FROM rated),
    p AS (SELECT *, round_even(k * 100.0::DOUBLE / n, 2) AS pct FROM c)
    SELECT "column", k AS missing_count, pct AS missing_pct, {_SEVERITY_SQL} AS severity, dtype FROM p WHERE k > 0""",
)
def _(spark, sf):
    return quality.missing_report(rated(spark, sf))


@query(
    "zero_report", 105,
    sql=f"""WITH {RATED_SQL}, c AS (SELECT 'rating_score' AS "column", count(*) FILTER (coalesce(rating_score, 0) = 0) AS "count", count(*) AS n FROM rated
      UNION ALL SELECT 'mentions', count(*) FILTER (coalesce(mentions, 0) = 0), count(*) FROM rated
      UNION ALL SELECT 'popularity', count(*) FILTER (coalesce(popularity, 0) = 0), count(*) FROM rated)
    SELECT "column", '{quality.ISSUE_ZERO}' AS issue, "count", round_even("count" * 100.0::DOUBLE / n, 2) AS pct, CASE WHEN round_even("count" * 100.0::DOUBLE / n, 2) > 50 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
    FROM c WHERE "count" > 0""",
)
def _(spark, sf):
    return quality.zero_report(rated(spark, sf))


def _outlier_sql(name: str) -> str:
    return f"""SELECT '{name}' AS "column", round_even(q1, 2) AS q1, round_even(q3, 2) AS q3, round_even(q3 - q1, 2) AS iqr, round_even(q1 - 1.5 * (q3 - q1), 2) AS lower_bound,
      round_even(q3 + 1.5 * (q3 - q1), 2) AS upper_bound, count(*) FILTER ({name} < q1 - 1.5 * (q3 - q1) OR {name} > q3 + 1.5 * (q3 - q1)) AS outliers,
      round_even(count(*) FILTER ({name} < q1 - 1.5 * (q3 - q1) OR {name} > q3 + 1.5 * (q3 - q1)) * 100.0::DOUBLE / count(*), 2) AS outlier_pct
    FROM x, (SELECT quantile_cont({name}, 0.25) AS q1, quantile_cont({name}, 0.75) AS q3 FROM x) WHERE {name} IS NOT NULL AND q1 <> q3 GROUP BY q1, q3"""


@query(
    "outlier_report", 106,
    sql="WITH x AS (SELECT l_extendedprice * l_quantity AS price, l_discount AS discount, l_quantity * l_quantity * l_quantity AS cube FROM lineitem) "
    + "SELECT * FROM ("
    + " UNION ALL ".join(_outlier_sql(n) for n in ("price", "discount", "cube"))
    + ") WHERE outliers > 0",
)
def _(spark, sf):
    q = F.col("l_quantity")
    x = table(spark, sf, "lineitem").select((F.col("l_extendedprice") * q).alias("price"), F.col("l_discount").alias("discount"), (q * q * q).alias("cube"))
    return quality.outlier_report(x)


@query(
    "score_report", 107,
    sql=f"""WITH x AS (SELECT o_totalprice / 40000 AS r, o_totalprice / 400000 - 0.01 AS s FROM orders)
    SELECT 'rating_score' AS "column", '{quality.ISSUE_SCORE}' AS issue, count(*) FILTER (r < 0 OR r > 10) AS "count", round_even(count(*) FILTER (r < 0 OR r > 10) * 100.0::DOUBLE / count(*), 2) AS pct, 'HIGH' AS severity FROM x
    UNION ALL SELECT 'sentiment_score', '{quality.ISSUE_SENTIMENT}', count(*) FILTER (s < 0 OR s > 1), round_even(count(*) FILTER (s < 0 OR s > 1) * 100.0::DOUBLE / count(*), 2), 'HIGH' FROM x""",
)
def _(spark, sf):
    price = F.col("o_totalprice")
    return quality.score_report(table(spark, sf, "orders").select((price / 40000).alias("rating_score"), (price / 400000 - 0.01).alias("sentiment_score")))


@query(
    "duplicate_report", 108,
    sql=f"""WITH x AS (SELECT o_orderkey AS record_id, o_custkey AS article_id, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority || '/' || o_custkey END AS url FROM orders),
    c AS (SELECT 'article_id' AS "column", count(article_id) - count(DISTINCT article_id) AS "count", count(*) AS n, 'MEDIUM' AS severity FROM x
      UNION ALL SELECT 'url', count(url) - count(DISTINCT url), count(*), 'HIGH' FROM x)
    SELECT "column", '{quality.ISSUE_DUPLICATE}' AS issue, "count", round_even("count" * 100.0::DOUBLE / n, 2) AS pct, severity FROM c WHERE "count" > 0""",
)
def _(spark, sf):
    url = F.when(F.col("o_orderstatus") != "F", F.concat_ws("/", "o_orderpriority", F.col("o_custkey").cast("string")))
    return quality.duplicate_report(table(spark, sf, "orders").select(F.col("o_orderkey").alias("record_id"), F.col("o_custkey").alias("article_id"), url.alias("url")))


_GAPPY_TITLE_SQL = f"""x AS (SELECT doc_id, n_chars, CASE WHEN source = 'src1' THEN NULL WHEN source = 'src2' THEN '  ' WHEN source = 'src3' THEN '--!__' WHEN source = 'src4' THEN lang ELSE text END AS title FROM documents),
t AS (SELECT *, {_trim("coalesce(title, '')")} AS s FROM x)"""


def _gappy_titles(spark, sf, name):
    s = F.col("source")
    title = F.when(s == "src1", F.lit(None)).when(s == "src2", "  ").when(s == "src3", "--!__").when(s == "src4", F.col("lang")).otherwise(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", title.alias(name), "n_chars")


def _issue_sql(column: str, issue: str, test: str, level: str) -> str:
    pct = f"round_even(count(*) FILTER ({test}) * 100.0::DOUBLE / count(*), 2)"
    severity = f"(SELECT {_SEVERITY_SQL} FROM (SELECT {pct} AS pct FROM t))" if level == "rule" else level.replace("pct", pct)
    return f"""SELECT '{column}' AS "column", '{issue}' AS issue, count(*) FILTER ({test}) AS "count", {pct} AS pct, {severity} AS severity FROM t"""


_TITLE_ISSUES = [
    (quality.ISSUE_TITLE_MISSING, "title IS NULL", "rule"),
    (quality.ISSUE_TITLE_EMPTY, "s = ''", "'MEDIUM'"),
    (quality.ISSUE_TITLE_FORM, r"regexp_full_match(s, '[^\p{L}\p{N}]+')", "'MEDIUM'"),
    (quality.ISSUE_TITLE_SHORT, "length(s) < 5", "'LOW'"),
]
_CONTENT_ISSUES = [
    (quality.ISSUE_CONTENT_EMPTY, "s = ''", "rule"),
    (quality.ISSUE_CONTENT_SHORT, "length(s) < 30", "CASE WHEN pct > 10 THEN 'MEDIUM' ELSE 'LOW' END"),
]


@query("title_report", 109, sql=f"WITH {_GAPPY_TITLE_SQL} SELECT * FROM (" + " UNION ALL ".join(_issue_sql("title", *i) for i in _TITLE_ISSUES) + ') WHERE "count" > 0')
def _(spark, sf):
    return quality.title_report(_gappy_titles(spark, sf, "title"))


@query("content_report", 110, sql=f"WITH {_GAPPY_TITLE_SQL} SELECT * FROM (" + " UNION ALL ".join(_issue_sql("description", *i) for i in _CONTENT_ISSUES) + ') WHERE "count" > 0')
def _(spark, sf):
    return quality.content_report(_gappy_titles(spark, sf, "description"))


@query(
    "format_report", 111,
    sql=f"""WITH t AS (SELECT event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) SELECT * FROM (
    {_issue_sql('published_date', quality.ISSUE_DATE, "event_type IN ('error', 'view')", "'MEDIUM'")}
    UNION ALL {_issue_sql('year', quality.ISSUE_YEAR, "event_type = 'click' AND (1850 + k < 1900 OR 1850 + k > 2100)", "'MEDIUM'")}) WHERE "count" > 0""",
)
def _(spark, sf):
    kind = F.col("event_type")
    date = F.when(kind == "error", "31.12.2024").when(kind == "view", "soon").when(kind == "signup", F.col("ts").cast("string"))
    year = F.when(kind == "click", (F.get_json_object("props", "$.k").cast("int") + 1850).cast("string")).when(kind == "view", "MMXX").otherwise("2024")
    return quality.format_report(table(spark, sf, "events").select(date.alias("published_date"), year.alias("year")))


@query(
    "full_report", 112,
    sql=f"""WITH {_GAPPY_TITLE_SQL} SELECT * FROM (
    {_issue_sql('title', quality.ISSUE_MISSING, 'title IS NULL', 'rule')}
    UNION ALL {" UNION ALL ".join(_issue_sql("title", *i) for i in _TITLE_ISSUES)}
    UNION ALL SELECT 'content_text', '{quality.ISSUE_CONTENT_COLUMN}', count(*), 100.0::DOUBLE, 'HIGH' FROM t
    UNION ALL SELECT "column", '{quality.ISSUE_OUTLIER}', outliers, outlier_pct, CASE WHEN outlier_pct > 30 THEN 'HIGH' WHEN outlier_pct > 10 THEN 'MEDIUM' ELSE 'LOW' END
      FROM ({_outlier_sql('n_chars').replace('FROM x', 'FROM t')})) WHERE "count" > 0""",
)
def _(spark, sf):
    return quality.full_report(_gappy_titles(spark, sf, "title"))


@query(
    "bad_dates", 113,
    sql=f"""SELECT event_id AS row_key, 'published_date' AS "column", strftime(ts, '%d.%m.%Y') AS value, '{quality.ISSUE_DATE_TEXT}' AS issue FROM events WHERE event_type = 'error'""",
)
def _(spark, sf):
    date = F.when(F.col("event_type") == "error", F.date_format("ts", "dd.MM.yyyy")).when(F.col("event_type") != "view", F.col("ts").cast("string"))
    return quality.bad_dates(table(spark, sf, "events").select("event_id", date.alias("published_date")), "event_id")


@query("bad_languages", 113, sql=f"""SELECT doc_id AS row_key, 'language' AS "column", lang || '-x' AS value, '{quality.ISSUE_LANGUAGE_TEXT}' AS issue FROM documents WHERE source = 'src5'""")
def _(spark, sf):
    code = F.when(F.col("source") == "src5", F.concat(F.upper("lang"), F.lit("-X "))).when(F.col("source") == "src6", "Unknown").when(F.col("source") != "src7", F.upper("lang"))
    return quality.bad_languages(table(spark, sf, "documents").select("doc_id", code.alias("language")), "doc_id")


@query("drop_incomplete", 114, sql=f"WITH {_GAPPY_TITLE_SQL} SELECT doc_id, title FROM t WHERE s <> ''")
def _(spark, sf):
    return clean.drop_incomplete(_gappy_titles(spark, sf, "title").drop("n_chars"), ["doc_id", "title", "no_such_column"])


@query("fill_texts", 115, sql=f"WITH {_GAPPY_TITLE_SQL} SELECT doc_id, CASE WHEN s = '' THEN 'No overview available.' ELSE title END AS overview FROM t")
def _(spark, sf):
    return clean.fill_overview(_gappy_titles(spark, sf, "overview")).drop("n_chars")


@query("fill_titles", 115, sql=f"WITH {_GAPPY_TITLE_SQL} SELECT doc_id, CASE WHEN s = '' THEN 'No text available.' ELSE title END AS title FROM t")
def _(spark, sf):
    return clean.fill_texts(_gappy_titles(spark, sf, "title")).drop("n_chars")


@query("zero_to_null", 116, sql="SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax FROM lineitem")
def _(spark, sf):
    return clean.zero_to_null(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax"), ["l_discount", "l_tax", "no_such_column"])


@query("fill_medians", 117, sql=f"WITH {RATED_SQL} SELECT record_id, coalesce(rating_score, (SELECT median(rating_score) FROM rated)) AS rating_score, coalesce(mentions, (SELECT median(mentions) FROM rated)) AS mentions FROM rated")
def _(spark, sf):
    return clean.fill_medians(rated(spark, sf).select("record_id", "rating_score", "mentions"), ["rating_score", "mentions"])


@query("drop_sparse", 118, sql=f"WITH {RATED_SQL} SELECT record_id, rating_score, popularity FROM rated")
def _(spark, sf):
    rows = rated(spark, sf).select("record_id", "rating_score", "popularity", F.when(F.col("language") == "fr", F.col("mentions")).alias("mentions"))
    return clean.drop_sparse(rows)


@query("missing_matrix", 119, sql=f"WITH {RATED_SQL} SELECT record_id, rating_score IS NULL AS rating_score_missing, mentions IS NULL AS mentions_missing FROM rated ORDER BY md5(record_id::VARCHAR || ':42'), record_id LIMIT 200")
def _(spark, sf):
    return quality.missing_matrix(rated(spark, sf), "record_id")


@query(
    "validation", 120,
    sql=f"""WITH {RATED_SQL}, v AS (SELECT *, rating_score * 1.2 AS r FROM rated)
    SELECT 'required_columns' AS "check", 0::BIGINT AS violations, true AS passed
    UNION ALL SELECT 'null_titles', k, k = 0 FROM (SELECT count(*) FILTER ({_trim('title')} = '') AS k FROM v)
    UNION ALL SELECT 'rating_score_range', k, k = 0 FROM (SELECT count(*) FILTER (r < 0 OR r > 10) AS k FROM v)
    UNION ALL SELECT 'year_range', 0, true UNION ALL SELECT 'language_codes', 0, true UNION ALL SELECT 'content_length', 0, true
    UNION ALL SELECT 'duplicate_ids', count(*), false FROM v""",
)
def _(spark, sf):
    rows = rated(spark, sf).withColumn("rating_score", F.col("rating_score") * 1.2)
    return quality.validate(rows.unionByName(rows.withColumn("title", F.lit("copy")).drop("rating_score"), allowMissingColumns=True))


_RAW_SQL = f"""raw0 AS (SELECT doc_id AS record_id, {_RAW_TITLE_SQL} AS title, text AS content_text, source AS category, 'Doc' AS document_type, lang AS language,
  CAST(quality * 7 + toxic * 2 AS DOUBLE) AS rating_score, n_chars AS content_length, CASE WHEN lang <> 'de' THEN 'http://h/' || source || '/' || n_chars END AS url,
  CASE WHEN lang <> 'es' THEN DATE '2026-03-01' + CAST(doc_id % 50 AS INTEGER) END AS day FROM documents LEFT JOIN labels USING (doc_id)),
raw AS (SELECT * FROM raw0 UNION ALL SELECT * FROM raw0 WHERE record_id % 11 = 0 UNION ALL SELECT * REPLACE (record_id + 1000000000 AS record_id) FROM raw0 WHERE record_id % 13 = 0)"""


def _raw(spark, sf):
    """Collected articles with gaps, repeated URLs and titles on a day, rows that came twice, and rows
    that came again under another id."""
    labels = table(spark, sf, "labels").select("doc_id", (F.col("quality") * 7 + F.col("toxic") * 2).cast("double").alias("rating_score"))
    day = F.date_add(F.lit("2026-03-01").cast("date"), (F.col("doc_id") % 50).cast("int"))
    once = table(spark, sf, "documents").join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("record_id"), _raw_title().alias("title"), F.col("text").alias("content_text"), F.col("source").alias("category"), F.lit("Doc").alias("document_type"),
        F.col("lang").alias("language"), "rating_score", F.col("n_chars").alias("content_length"),
        F.when(F.col("lang") != "de", F.concat_ws("/", F.lit("http://h"), "source", F.col("n_chars").cast("string"))).alias("url"),
        F.when(F.col("lang") != "es", day.cast("string")).alias("published_date"),
    )
    renamed = once.where("record_id % 13 = 0").withColumn("record_id", F.col("record_id") + 1_000_000_000)
    return once.unionByName(once.where("record_id % 11 = 0")).unionByName(renamed)


_CLEANED_SQL = f"""{_RAW_SQL}, c AS (SELECT record_id, {_title_sql('title')} AS title, {_body_sql('content_text')} AS content_text, {_label_sql('category')} AS category, 'doc' AS document_type, language,
  nullif(rating_score, 0) AS rating_score, content_length, url, day FROM raw WHERE {_trim('title')} <> ''),
m AS (SELECT * REPLACE (coalesce(rating_score, (SELECT median(rating_score) FROM c)) AS rating_score) FROM c),
u0 AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY record_id, title, content_text, category, language, rating_score, content_length, url, day ORDER BY record_id) = 1),
u1 AS (SELECT * FROM u0 QUALIFY url IS NULL OR row_number() OVER (PARTITION BY url ORDER BY record_id) = 1),
u2 AS (SELECT * FROM u1 QUALIFY day IS NULL OR row_number() OVER (PARTITION BY title, day ORDER BY record_id) = 1)"""


@query(
    "clean_all", 121, 97,
    sql=f"""WITH {_CLEANED_SQL} SELECT record_id, title, content_text, category, document_type, language, CAST(rating_score AS FLOAT) AS rating_score, content_length, url,
    CAST(year(day) AS BIGINT) AS published_year, day AS published_date FROM u2""",
)
def _(spark, sf):
    out = cleaning.clean_all(_raw(spark, sf), ["record_id"], check=True)
    return out.withColumn("published_date", F.col("published_date").cast("date")).drop("release_year")


@query("step_counts", 121, sql=f"WITH {_CLEANED_SQL} SELECT 'input' AS step, count(*) AS \"rows\" FROM c UNION ALL SELECT 'equal_rows', count(*) FROM u0 UNION ALL SELECT 'url', count(*) FROM u1 UNION ALL SELECT 'title_date', count(*) FROM u2 UNION ALL SELECT 'id', count(*) FROM u2")
def _(spark, sf):
    return cleaning.step_counts(_raw(spark, sf), ["record_id"])


@query("distinct_rows", 122, sql="SELECT DISTINCT doc_id, text, lang, source, n_chars FROM (SELECT * FROM documents UNION ALL SELECT * REPLACE (doc_id // 2 AS doc_id) FROM documents WHERE doc_id % 4 <> 3)")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    moved = docs.where("doc_id % 4 <> 3").withColumn("doc_id", F.floor(F.col("doc_id") / 2))
    return dedup.distinct_rows(docs.unionByName(moved))


@query("first_arrivals", 122, sql="SELECT doc_id AS seq, text, lang, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY text, lang, n_chars ORDER BY doc_id) = 1")
def _(spark, sf):
    arrived = table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), "text", "lang", "n_chars")
    return dedup.distinct_rows(arrived, ignore=["seq"], order=["seq"])


@query("distinct_nested_rows", 122, sql="SELECT min(vec_id) AS vec_id, label FROM embeddings GROUP BY embedding, label")
def _(spark, sf):
    e = table(spark, sf, "embeddings")
    twice = e.unionByName(e.withColumn("vec_id", F.col("vec_id") + 1_000_000))
    return dedup.distinct_rows(twice, ignore=["vec_id"]).drop("embedding")


@query("repeats", 123, sql="SELECT count(*) - count(DISTINCT coalesce(user_id, -1)) AS duplicate_count FROM (SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id FROM events)")
def _(spark, sf):
    users = table(spark, sf, "events").select(F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"))
    return dedup.repeats(users, "user_id")


@query("first_event_per_user", 124, sql="SELECT event_id, user_id AS id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", F.col("user_id").alias("id"), "event_type")
    return dedup.by_id(events, ["ts", "event_id"]).drop("ts")


@query(
    "first_per_url", 125,
    sql=r"""WITH p AS (SELECT page_id, CASE WHEN html LIKE '%lang="fr"%' THEN NULL WHEN html LIKE '%lang="de"%' THEN ' ' ELSE regexp_extract(url, '^(https?://[^/]+)', 1) END AS url FROM pages)
    SELECT page_id, url FROM p QUALIFY url IS NULL OR trim(url) = '' OR row_number() OVER (PARTITION BY url ORDER BY page_id) = 1""",
)
def _(spark, sf):
    html = F.col("html")
    url = F.when(html.contains('lang="fr"'), F.lit(None)).when(html.contains('lang="de"'), " ").otherwise(F.regexp_extract("url", "^(https?://[^/]+)", 1))
    return dedup.by_url(table(spark, sf, "pages").select("page_id", url.alias("url")), ["page_id"])


@query(
    "first_per_title_and_date", 126,
    sql="""WITH o AS (SELECT o_orderkey, o_orderpriority AS title, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS release_date FROM orders)
    SELECT o_orderkey, title, release_date FROM o QUALIFY release_date IS NULL OR row_number() OVER (PARTITION BY title, release_date ORDER BY o_orderkey) = 1""",
)
def _(spark, sf):
    date = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("title"), date.alias("release_date"))
    return dedup.by_title_and_date(orders, ["o_orderkey"])


@query(
    "normalise_documents", 18, 19,
    sql="""WITH j AS (SELECT d.doc_id AS record_id, CASE WHEN lang = 'en' THEN text END AS description, CASE WHEN lang = 'fr' THEN '  ' WHEN lang <> 'es' THEN text END AS raw_text, lang, source, n_chars, quality, toxic
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    b AS (SELECT *, CASE WHEN lang IN ('en', 'de') THEN coalesce(description, raw_text) ELSE 'file_' || source || '.pdf' END AS content_text, CASE WHEN lang = 'fr' THEN n_chars END AS mentions FROM j),
    k AS (SELECT *, CASE WHEN lang = 'en' THEN 'json' WHEN lang = 'de' THEN 'word' ELSE 'pdf' END AS document_type FROM b)
    SELECT record_id, document_type, 'file_' || source || '.pdf' AS title, source AS source_name, 'unknown' AS language, content_text, document_type AS category, length(content_text)::INTEGER AS content_length,
      round(coalesce(quality * 5.0, (mentions - (SELECT min(mentions) FROM k)) / ((SELECT max(mentions) FROM k) - (SELECT min(mentions) FROM k)) * 10, least(greatest(length(content_text) / 1000 * 10, 0), 10)), 6) AS rating_score,
      coalesce(mentions, length(content_text))::DOUBLE AS popularity, coalesce(mentions, 1)::DOUBLE AS vote_count, 2026 AS published_year FROM k""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    lang = F.col("lang")
    raw = docs.select(
        F.col("doc_id").alias("record_id"),
        F.when(lang == "en", F.col("text")).alias("description"),
        F.when(lang == "fr", "  ").when(lang != "es", F.col("text")).alias("raw_text"),
        F.when(lang == "de", "word").alias("type"),
        F.concat(F.lit("file_"), "source", F.lit(".pdf")).alias("name"),
        F.when(lang != "en", F.concat(F.lit("file_"), "source", F.lit(".pdf"))).alias("file_name"),
        F.when(lang == "en", F.concat(F.lit("data/News_Page_"), "source")).alias("source_path"),
        F.col("source").alias("source_name"),
        F.lit("2026-03-01T10:00:00Z").alias("publishedAt"),
        F.when(lang == "fr", F.col("n_chars")).alias("mentions"),
        (F.col("quality") * 0.5).alias("sentiment_score"),
    )
    out = normalise(raw)
    names = ["record_id", "document_type", "title", "source_name", "language", "content_text", "category", "content_length", "rating_score", "popularity", "vote_count", "published_year"]
    return rounded(out.select(*names), 6, "rating_score")
