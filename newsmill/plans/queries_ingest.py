"""Semi-structured records to tables; files and stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsmill.functions import text as tx
from newsmill.operators import clean, ingest, joins, quality
from newsmill.plans.registry import query
from newsmill.plans.stand_ins import ARTICLES_SQL, RATED_SQL, SQL_WHITE, articles, rated
from newsmill.session import scratch_path, table
from newsmill.sources import files, stores

_FLAT_SQL = """SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(user_id AS VARCHAR) AS source_id, event_type AS source_name, 'feed/' || event_type AS source_path,
ts AS fetched_at, 1 AS version, CASE WHEN event_type = 'error' THEN 'ocr' ELSE 'json' END AS type FROM events"""


def _envelopes(spark, sf):
    events = table(spark, sf, "events")
    source = F.struct(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("name"))
    payload = F.struct(
        F.from_json("props", "k INT")["k"].alias("k"), source.alias("source"), F.when(F.col("event_type") == "error", "ocr").alias("type")
    )
    return stores.envelope(events, payload, F.concat(F.lit("feed/"), "event_type"), F.col("ts"), {"type": F.lit("json")})


@query("flatten_envelopes", 17, sql=_FLAT_SQL)
def _(spark, sf):
    return ingest.flatten_envelopes(_envelopes(spark, sf))


@query("flatten_variant", 17, sql=_FLAT_SQL)
def _(spark, sf):
    raw = _envelopes(spark, sf).withColumn("data", F.parse_json(F.to_json("data")))
    return ingest.flatten_variant(raw, {"k": "int", "type": "string"})


@query("flatten_texts", 17, sql="SELECT text AS content_text, source AS source_path, 1 AS version FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return ingest.flatten_envelopes(docs.select(F.col("text").alias("data"), "source", F.lit(1).alias("version")))


@query(
    "first_text", 19,
    sql="SELECT doc_id, CASE WHEN lang = 'fr' THEN source ELSE text END AS content_text FROM documents",
)
def _(spark, sf):
    lang, text = F.col("lang"), F.col("text")
    docs = table(spark, sf, "documents").select(
        "doc_id", "source", F.when(lang == "en", text).otherwise(" \n").alias("description"), F.when(lang == "de", text).alias("processed_text"), F.when(lang == "es", text).alias("transcript")
    )
    return docs.select("doc_id", ingest.first_text(docs, ["description", "text", "processed_text", "transcript"], F.col("source")).alias("content_text"))


@query(
    "html_rows", 20,
    sql=r"""SELECT page_id, generate_subscripts(m, 1)::INTEGER - 1 AS position, trim(replace(regexp_extract(unnest(m), '<a[^>]*href="([^"]*)"', 1), '&amp;', '&')) AS href,
    trim(replace(regexp_replace(regexp_extract(unnest(m), '<a[^>]*>(.*?)</a>', 1), '<[^>]*>', '', 'g'), '&amp;', '&')) AS label
    FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1) AS m FROM pages)""",
)
def _(spark, sf):
    return ingest.html_rows(table(spark, sf, "pages"), "html", ingest.LINK_ROW, ingest.LINK_CELLS, ["page_id"])


@query(
    "html_table_rows", 20,
    sql="SELECT s_nationkey, s_name || ' & <é' AS name, CAST(s_suppkey AS VARCHAR) AS year, CASE WHEN s_acctbal < 0 THEN '' ELSE CAST(s_nationkey AS VARCHAR) END AS wins, '' AS losses FROM supplier",
)
def _(spark, sf):
    # One page per supplier and nation, with one table row; some cells are absent.
    # Attributes are quoted in both ways or not at all, and characters are written as references.
    quotes = {"name": "'name'", "year": "year", "wins": '"x wins"'}
    cell = lambda name, value: F.concat(F.lit(f"<td class={quotes[name]}> "), value, F.lit("\n</td>"))
    suppliers = table(spark, sf, "supplier")
    wins = F.when(F.col("s_acctbal") < 0, "").otherwise(cell("wins", F.col("s_nationkey").cast("string")))
    row = F.concat(F.lit('<table><tr class="team">'), cell("name", F.concat("s_name", F.lit(" &amp; &lt;&#xe9;"))), cell("year", F.col("s_suppkey").cast("string")), wins, F.lit("</tr></table>"))
    pages = suppliers.select("s_nationkey", row.alias("html"))
    return ingest.html_rows(pages, "html", ingest.TEAM_ROW, ingest.TEAM_CELLS, ["s_nationkey"]).drop("position")


@query(
    "json_records", 21,
    sql="""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS title, CAST(o_orderkey AS VARCHAR) AS nominations,
    o_orderstatus = 'F' AS best_picture FROM orders""",
)
def _(spark, sf):
    # API pages of at most a hundred records each: an order key occurs once.
    record = F.struct(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("title"), F.col("o_orderkey").cast("string").alias("nominations"), F.when(F.col("o_orderstatus") == "F", True).alias("best_picture")
    )
    pages = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), F.floor(F.col("o_orderkey") / 100)).agg(F.to_json(F.collect_list(record)).alias("body"))
    return ingest.json_records(pages, "body", "title STRING, nominations STRING, best_picture BOOLEAN", {"title": "", "nominations": "", "best_picture": False}, ["year"])


@query(
    "image_links", 22,
    sql=r"""SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) || '/logo' AS "urlToImage", 'logo.jpg' AS file_name FROM pages
    QUALIFY row_number() OVER (PARTITION BY regexp_extract(url, '^(https?://[^/]+)', 1) ORDER BY page_id) = 1""",
)
def _(spark, sf):
    link = F.concat(F.regexp_extract("url", "^(https?://[^/]+)", 1), F.lit("/logo"))
    return ingest.image_links(table(spark, sf, "pages").select("page_id", link.alias("urlToImage")), "page_id")


@query(
    "url_file_names", 23,
    sql=r"""SELECT page_id, CASE WHEN b = '' THEN 'image.jpg' WHEN contains(b, '.') THEN b ELSE b || '.jpg' END AS file_name FROM (
    SELECT page_id, regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '^.*/', '') AS b FROM pages)""",
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.file_name_from_url(F.col("url")).alias("file_name"))


def _chunks(spark, sf):
    """Each turn of a conversation as a recorded chunk with one segment and its words."""
    turns = table(spark, sf, "conversations")
    length = F.char_length("text") / 10.0
    words = F.transform(
        F.split("text", r"\s+"),
        lambda w, i: F.struct(w.alias("word"), (i * 0.5).alias("start"), (i * 0.5 + 0.4).alias("end"), F.lit(0.9).alias("probability")),
    )
    return turns.select(
        F.col("conv_id").alias("source_file"), F.col("turn").alias("chunk"), F.concat(F.lit(" "), "text").alias("text"), F.lit(0.0).alias("start"), length.alias("end"), words.alias("words"),
        length.alias("duration_s"), F.col("role").alias("language"), F.lit(0.9).alias("language_probability"),
    )


_OFFSET_SQL = "coalesce(sum(length(text) / 10.0) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE"


@query(
    "shifted_segments", 24,
    sql=rf"""SELECT conv_id AS source_file, turn AS chunk, round(o, 3) AS "start", round(o + length(text) / 10.0::DOUBLE, 3) AS "end",
    round(o + 0.5 * (n - 1), 3) AS last_word_start, n AS words FROM (SELECT *, {_OFFSET_SQL} AS o, len(regexp_split_to_array(text, '\s+'))::INTEGER AS n FROM conversations)""",
)
def _(spark, sf):
    chunks = _chunks(spark, sf)
    out = ingest.shift_segments(chunks.select("source_file", "chunk", "start", "end", "words"), chunks.select("source_file", "chunk", "duration_s"))
    last = F.element_at("words", -1)["start"].alias("last_word_start")
    return out.select("source_file", "chunk", "start", "end", last, F.size("words").alias("words"))


@query(
    "recording_summary", 24,
    sql="""SELECT conv_id AS source_file, arg_min(role, turn) AS language, 0.9::DOUBLE AS language_probability, count(*) AS total_chunks,
    round_even(sum(length(text) / 10.0::DOUBLE), 2) AS duration_s FROM conversations GROUP BY conv_id""",
)
def _(spark, sf):
    return ingest.recording_summary(_chunks(spark, sf))


@query(
    "transcript_envelopes", 25,
    sql="""SELECT role AS source_file, 'conv/' || conv_id || '/' || turn AS source_path, 'audio' AS source_type, 'unknown' AS model, '' AS language, 0.0::DOUBLE AS language_probability,
    length(text) / 10.0::DOUBLE AS duration_s, text AS full_text, 'transcript' AS type FROM conversations""",
)
def _(spark, sf):
    turns = table(spark, sf, "conversations")
    transcripts = turns.select("conv_id", "turn", F.col("role").alias("source_file"), (F.char_length("text") / 10.0).alias("duration_s"), F.col("text").alias("full_text"))
    path = F.concat_ws("/", F.lit("conv"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    out = ingest.transcript_envelope(transcripts, path)
    return out.drop("total_chunks", "segments", "transcript_json_path", "transcript_txt_path", "transcript_srt_path")


@query(
    "stored_envelopes", 25,
    sql="""SELECT role AS source_file, 'conv/' || conv_id || '/' || turn AS source_path, 'video' AS source_type, 'small' AS model, left(role, 2) AS language, 0.5::DOUBLE AS language_probability,
      length(text)::DOUBLE AS duration_s, turn AS total_chunks, text AS full_text, turn || '-' || turn + 1 || ': ' || text AS segments,
      'conv/' || conv_id || '/' || turn || '.json' AS transcript_json_path, 'conv/' || conv_id || '/' || turn || '.txt' AS transcript_txt_path, NULL::VARCHAR AS transcript_srt_path,
      'transcript' AS type, '2026-01-02' AS fetched_on
    FROM conversations""",
)
def _(spark, sf):
    segment = F.struct(F.col("turn").cast("double").alias("start"), (F.col("turn") + 1).cast("double").alias("end"), "text")
    transcripts = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("role").alias("source_file"), F.lit("small").alias("model"), F.left("role", F.lit(2)).alias("language"), F.lit(0.5).alias("language_probability"),
        F.char_length("text").cast("double").alias("duration_s"), F.col("turn").alias("total_chunks"), F.col("text").alias("full_text"), F.array(segment).alias("segments"),
    )
    path = F.concat_ws("/", F.lit("conv"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    out = ingest.transcript_envelope(transcripts, path, "video", {"json": F.concat(path, F.lit(".json")), "txt": F.concat(path, F.lit(".txt"))})
    lines = F.transform("segments", lambda s: F.concat(s["start"].cast("int").cast("string"), F.lit("-"), s["end"].cast("int").cast("string"), F.lit(": "), s["text"]))
    return out.withColumns({"segments": F.array_join(lines, "\n"), "fetched_on": F.lit("2026-01-02")})


@query("transcript_exports", 25, sql="SELECT conv_id, regexp_replace(text, '[\\r\\n]', ' ', 'g') AS line, count(*) AS times FROM conversations GROUP BY ALL")
def _(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", F.regexp_replace("text", r"[\r\n]", " ").alias("text"))
    path = scratch_path(spark, "exports")
    stores.export_lines(turns, path, "conv_id", ["turn"], F.col("text"))
    lines = stores.exported_lines(spark, path).withColumnRenamed("value", "line")
    return lines.groupBy(F.col("conv_id").cast("bigint").alias("conv_id"), "line").agg(F.count(F.lit(1)).alias("times"))


def _time_sql(e: str) -> str:
    return f"printf('%02d:%02d:%02d,%03d', CAST(floor({e} / 3600) AS BIGINT), CAST(floor({e} % 3600 / 60) AS BIGINT), CAST(floor({e} % 60) AS BIGINT), CAST(floor(({e} % 1) * 1000) AS BIGINT))"


@query(
    "subtitle_cues", 26,
    sql=f"""SELECT conv_id AS source_file, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS cue, {_time_sql('(turn * 1234.5678::DOUBLE)')} || ' --> ' || {_time_sql('(turn * 1234.5678::DOUBLE + length(text))')} AS times,
    trim(text, {SQL_WHITE}) AS text FROM conversations""",
)
def _(spark, sf):
    start = F.col("turn") * 1234.5678
    turns = table(spark, sf, "conversations").select(F.col("conv_id").alias("source_file"), "turn", start.alias("start"), (start + F.char_length("text")).alias("end"), "text")
    return ingest.cues(turns, "source_file", "turn")


@query("text_runs", 28, sql="SELECT doc_id AS paragraph_number, source AS text FROM documents WHERE lang <> 'fr'")
def _(spark, sf):
    run = F.when(F.col("lang") == "fr", " \t ").otherwise(F.concat(F.lit("  "), "source", F.lit("\n")))
    return ingest.text_runs(table(spark, sf, "documents").select(F.col("doc_id").alias("paragraph_number"), run.alias("text")))


@query("sheet_rows", 28, sql="SELECT doc_id, CAST(quality AS DOUBLE) AS sentiment_score, toxic AS mentions FROM documents JOIN labels USING (doc_id)")
def _(spark, sf):
    sheet = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    rows = sheet.select("doc_id", F.col("quality").cast("double").alias("sentiment_score"), F.col("toxic").alias("mentions"))
    return ingest.sheet_rows(rows, ["sentiment_score", "mentions"])


_KEYS = ["click", "error", "purchase", "signup", "view"]


@query("key_values", 28, sql="SELECT user_id, " + ", ".join(f"arg_max(value, event_id) FILTER (event_type = '{k}') AS \"{k}\"" for k in _KEYS) + " FROM events GROUP BY user_id")
def _(spark, sf):
    return ingest.key_values(table(spark, sf, "events"), "user_id", "event_type", "value", "event_id", _KEYS)


# Files: each query writes a table in the format, then reads it back through the reader.


@query(
    "csv_scan", 1, 12,
    sql="""SELECT o_orderkey AS record_id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS category, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS rating_score,
    CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END AS published_date FROM orders""",
)
def _(spark, sf):
    status = F.col("o_orderstatus")
    dirty = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("record_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.col("o_orderpriority")).alias("category"),
        F.when(status == "P", "None").otherwise(F.col("o_totalprice").cast("string")).alias("rating_score"),
        F.when(status == "F", "no date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("published_date"),
    )
    paths = stores.write_results({"raw": dirty}, scratch_path(spark, "csv"))
    out = files.read_csv(spark, paths["raw"], {"record_id": "bigint", "category": "string", "rating_score": "double", "published_date": "timestamp"})
    return out.withColumn("published_date", F.col("published_date").cast("timestamp_ntz"))


@query("tagged_csv_scan", 2, sql="SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title, p_type AS category, 'csv' AS document_type, true AS has_file FROM part")
def _(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_type").alias("category"))
    paths = stores.write_results({"part": part}, scratch_path(spark, "csv"))
    out = files.read_tagged_csv(spark, paths["part"], ["id", "title", "category"])
    return out.select("id", "title", "category", "document_type", F.col("file_name").endswith(".csv").alias("has_file"))


@query("multi_line_csv", 1, 12, sql="SELECT doc_id AS record_id, text AS content_text FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("record_id"), F.col("text").alias("content_text"))
    paths = stores.write_results({"docs": docs}, scratch_path(spark, "csv"))
    return files.read_csv(spark, paths["docs"], {"record_id": "bigint", "content_text": "string"}, na=[], multi_line=True)


def _article_pages(spark, sf) -> str:
    """API pages of at most a hundred articles, one page per line."""
    docs = table(spark, sf, "documents")
    source = F.struct(F.lit(None).cast("string").alias("id"), F.col("source").alias("name"))
    article = F.struct(source.alias("source"), F.col("lang").alias("author"), F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("description"), F.col("doc_id").cast("string").alias("url"))
    pages = docs.groupBy(F.floor(F.col("doc_id") / 100)).agg(F.count(F.lit(1)).alias("totalResults"), F.collect_list(article).alias("articles"))
    path = scratch_path(spark, "pages")
    pages.select(F.lit("ok").alias("status"), "totalResults", "articles").write.json(path)
    return path


@query(
    "article_pages", 3,
    sql="""SELECT source, lang AS author, split_part(text, chr(10), 1) AS title, text AS description, CAST(doc_id AS VARCHAR) AS url, NULL::VARCHAR AS "publishedAt", 'json' AS document_type FROM documents""",
)
def _(spark, sf):
    return files.read_article_pages(spark, _article_pages(spark, sf), multi_line=False).drop("file_name", "extraction_timestamp")


@query("article_fields", 3, sql="SELECT lang AS author, CAST(doc_id AS VARCHAR) AS url, NULL::VARCHAR AS content FROM documents")
def _(spark, sf):
    return files.read_article_fields(spark, _article_pages(spark, sf), multi_line=False).select("author", "url", "content")


@query("xml_rows", 4, sql="SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title, CASE WHEN p_size > 25 THEN p_type END AS category, 'xml' AS document_type FROM part")
def _(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.when(F.col("p_size") > 25, F.col("p_type")).alias("category"))
    path = scratch_path(spark, "xml")
    part.write.format("xml").option("rootTag", "articles").option("rowTag", "article").save(path)
    return files.read_xml_rows(spark, path).select("id", "title", "category", "document_type")


@query("json_objects", 5, sql="SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id, event_type = 'error' AS is_bad FROM events")
def _(spark, sf):
    events = table(spark, sf, "events")
    line = F.to_json(F.struct("event_id", "user_id", "value"))
    # The lines of one kind are cut off in the middle.
    broken = F.when(F.col("event_type") == "error", F.left(line, F.char_length(line) - 5)).otherwise(line)
    path = scratch_path(spark, "json")
    events.select(broken.alias("value")).write.text(path)
    return files.read_json_objects(spark, path, "event_id BIGINT, user_id BIGINT, value DOUBLE").select("event_id", "is_bad")


@query("decoded_bytes", 6, sql="SELECT doc_id, CASE WHEN lang = 'de' THEN regexp_replace(text, '[^\\x00-\\xff]', '', 'g') ELSE text END AS text FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    latin = F.regexp_replace("text", r"[^\x00-\xFF]", "")
    marked = F.concat(F.unhex(F.lit("FFFE")), F.encode("text", "UTF-16LE"))
    content = F.when(F.col("lang") == "fr", marked).when(F.col("lang") == "de", F.encode(latin, "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    return docs.select("doc_id", tx.decode_bytes(content, "ISO-8859-1").alias("text"))


# Stores.


@query("store_scan", 7, sql="SELECT doc_id, lang, n_chars FROM documents WHERE source = 'src1' AND lang = 'en'")
def _(spark, sf):
    return stores.scan_documents(spark, f"{sf}/documents.parquet", {"source": "src1", "lang": "en"}).select("doc_id", "lang", "n_chars")


@query("source_with_fallback", 8, 99, sql=f"WITH {ARTICLES_SQL} SELECT record_id, category, 0 AS published_year, 0 AS rating_score FROM articles")
def _(spark, sf):
    out = files.with_fallback(lambda: stores.scan_documents(spark, f"{sf}/no_such_store.parquet"), lambda: articles(spark, sf))
    return clean.dashboard_rows(out).select("record_id", "category", "published_year", F.col("rating_score").cast("int").alias("rating_score"))


@query("metrics_scan", 9, sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 300000 ORDER BY o_totalprice DESC")
def _(spark, sf):
    return stores.scan_metrics(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 300000, ["o_orderkey"])


@query("upsert", 10, sql="SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 2 END AS o_totalprice, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    old = orders.where("o_orderstatus <> 'O'").drop("o_orderstatus")
    new = orders.where("o_orderstatus <> 'F'").drop("o_orderstatus", "o_orderpriority")
    # Each incoming row comes twice; the later one holds.
    twice = new.select("o_orderkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("seq"), (F.col("o_totalprice") + F.col("seq")).alias("o_totalprice"))
    merged = stores.upsert_to(old.withColumn("seq", F.lit(0)), twice, "o_orderkey", scratch_path(spark, "upsert"), ["seq"])
    return merged.drop("seq")


@query(
    "metrics_table", 11, 91,
    sql=f"""WITH {RATED_SQL} SELECT record_id, document_type, CAST(coalesce(rating_score, 0) AS FLOAT) AS rating_score, CAST(content_length AS INTEGER) AS content_length,
    CAST(coalesce(rating_score, 0) * 10 + popularity * 0.05 + content_length * 0.01 AS FLOAT) AS engagement_score FROM rated WHERE trim(title, '{tx.WHITE}') <> ''""",
)
def _(spark, sf):
    metrics = clean.article_metrics(rated(spark, sf), ["record_id"])
    path = scratch_path(spark, "metrics")
    out = stores.load_table(metrics, "article_metrics_" + path[-12:], path)
    return out.select("record_id", "document_type", "rating_score", "content_length", "engagement_score")


@query("result_files", 12, sql="""SELECT 'inner' AS join_type, count(*) AS row_count FROM documents JOIN labels USING (doc_id) UNION ALL SELECT 'left', count(*) FROM documents
UNION ALL SELECT 'right', count(*) FROM labels UNION ALL SELECT 'outer', count(*) FROM documents""")
def _(spark, sf):
    docs, labels = (table(spark, sf, t).withColumnRenamed("doc_id", "record_id") for t in ("documents", "labels"))
    results = {"join_counts": joins.join_counts(docs, labels), "missing": quality.missing_report(rated(spark, sf))}
    paths = stores.write_results(results, scratch_path(spark, "results"))
    return files.read_csv(spark, paths["join_counts"], {"join_type": "string", "row_count": "bigint"})


@query("raw_envelopes", 13, sql="SELECT event_type AS source, ts AS fetched_at, 1 AS version, CASE WHEN event_type = 'error' THEN 'ocr' ELSE 'web_scraping' END AS type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, sf):
    events = table(spark, sf, "events")
    path = scratch_path(spark, "raw")
    for kind, test in (("ocr", "event_type = 'error'"), ("web_scraping", "event_type <> 'error'")):
        part = events.where(test)
        stores.append(stores.envelope(part, F.col("props"), F.col("event_type"), F.col("ts"), {"type": F.lit(kind)}), path, ["type"])
    raw = spark.read.parquet(path)
    return raw.select("source", "fetched_at", "version", "type", F.try_variant_get(F.parse_json("data"), "$.k", "bigint").alias("k"))


@query(
    "field_upsert", 14,
    sql="""SELECT p_partkey AS filename, CASE WHEN p_size BETWEEN 11 AND 40 THEN 'new' WHEN p_size <= 10 THEN p_name END AS format,
    CASE WHEN p_size BETWEEN 11 AND 20 THEN NULL WHEN p_size BETWEEN 21 AND 40 THEN p_retailprice WHEN p_size <= 10 THEN p_retailprice ELSE -1 END AS width,
    CASE WHEN p_size <= 40 THEN p_brand END AS mode FROM part""",
)
def _(spark, sf):
    part = table(spark, sf, "part")
    size = F.col("p_size")
    old = part.where(size <= 40).select(F.col("p_partkey").alias("filename"), F.col("p_name").alias("format"), F.col("p_retailprice").alias("width"), F.col("p_brand").alias("mode"))
    # Two kinds of change: a new format with an explicit NULL width, and a new format alone. The largest parts are not stored yet.
    new = part.where(size > 10).select(
        F.col("p_partkey").alias("filename"),
        F.when(size <= 40, "new").alias("format"),
        F.when(size > 40, -1.0).alias("width"),
        F.when(size <= 20, F.array(F.lit("format"), F.lit("width"))).when(size <= 40, F.array(F.lit("format"))).otherwise(F.array(F.lit("width"))).alias("given"),
    )
    return joins.merge_fields(old, new, "filename", "given")


@query("metadata_reads", 15, sql="SELECT event_id, event_type FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, 'any' FROM events")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    clicks = stores.where_given(events, "event_type", "click")
    return clicks.unionByName(stores.where_given(events, "event_type").withColumn("event_type", F.lit("any")))


@query("serving_table", 16, sql=f"WITH {RATED_SQL} SELECT record_id, category, rating_score FROM rated")
def _(spark, sf):
    # Gaps arrive as NaN, as a data frame library writes them.
    rows = rated(spark, sf).select("record_id", "category", F.coalesce("rating_score", F.lit(float("nan"))).alias("rating_score"))
    return stores.reload_serving(rows, scratch_path(spark, "serving"))
