"""WARC derivatives: metadata and plain-text conversion records of response records."""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.functions.text import decode_entities

CRLF = "\r\n"
_MARK = "WARC/1.1"
# Response records: id, target, date, digest of the payload, and the HTTP message.
RESPONSE = ["record_id", "target_uri", "date", "payload_digest", "block"]

# Elements that begin a line, and what is no text.
_LINE_TAGS = "address|article|aside|blockquote|br|dd|div|dl|dt|footer|h1|h2|h3|h4|h5|h6|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
_DROPPED = (r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>", r"(?s)<!--.*?-->", r"(?is)<title\b.*?</title\s*>")


def digest(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content.cast("binary"), 256))


def urn(*parts: Column) -> Column:
    """A record id that depends on its parts only, so that a task that runs again gives the same."""
    h = F.md5(F.concat_ws("\n", *parts).cast("binary"))
    cuts = [F.substr(h, F.lit(a), F.lit(n)) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def responses(pages: DataFrame, date: str, key: Sequence[str] = ("page_id", "url"), url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records of stored pages, with the columns ``key`` and those of ``RESPONSE``.

    Rows equal in key and page have one record id. A NULL page is an empty one, a NULL URL stays NULL.
    """
    html = F.coalesce(col(html_col), F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(html).cast("string"))
    named = pages.select(*[col(k).alias(f"_nm_{i}") for i, k in enumerate(key)], col(url_col).alias("target_uri"), head.alias("_nm_head"), html.alias("_nm_html"))
    payload = digest(F.col("_nm_html"))
    parts = [F.coalesce(F.col(f"_nm_{i}").cast("string"), F.lit("")) for i in range(len(key))]
    return named.select(
        *[F.col(f"_nm_{i}").alias(k) for i, k in enumerate(key)], urn(F.lit("response"), *parts, payload).alias("record_id"), "target_uri",
        F.lit(date).alias("date"), payload.alias("payload_digest"), F.concat("_nm_head", F.lit(CRLF * 2), "_nm_html").alias("block"),
    )


def head_of(block: Column) -> Column:
    """Status line and headers of an HTTP message, all of it if no blank line follows."""
    at = F.instr(block, CRLF * 2)
    return F.when(at > 0, F.substr(block, F.lit(1), at - 1)).otherwise(block)


def payload_of(block: Column) -> Column:
    at = F.instr(block, CRLF * 2)
    return F.when(at > 0, F.substr(block, at + 4)).otherwise(F.lit(""))


# References that are replaced one after the other, the ampersand last; the others go through a table.
_COMMON = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&"))
_OTHER = "&(?!(?:" + "|".join(name[1:-1] for name, _ in _COMMON) + ");)[A-Za-z#]"


def decoded(text: Column) -> Column:
    """Character references as the characters that they stand for, each decoded once, a no-break space as a blank."""
    common = text
    for name, value in _COMMON:
        common = F.replace(common, F.lit(name), F.lit(value))
    every = F.when(F.rlike(text, F.lit(_OTHER)), decode_entities(F.replace(text, F.lit("&nbsp;"), F.lit(" ")))).otherwise(common)
    return F.when(F.contains(text, F.lit("&")), every).otherwise(text)


def bare_text(html: Column) -> Column:
    """A page without scripts, styles, comments, title and tags, one line per block element, references as they are."""
    for pattern in _DROPPED:
        html = F.regexp_replace(html, pattern, " ")
    # A line begins only at an element; runs of blanks are made one in plain_text.
    for blank in "\t\r\n\f":
        html = F.replace(html, F.lit(blank), F.lit(" "))
    html = F.regexp_replace(html, rf"(?i)</?(?:{_LINE_TAGS})\b[^>]*>", "\n")
    return F.regexp_replace(html, r"<[^>]*>", "")


def plain_text(bare: Column) -> Column:
    """Text of a page from :func:`bare_text`, line by line, so that most lines need no pattern: no reference
    goes over the end of a line."""

    def tidy(line: Column) -> Column:
        text = F.regexp_replace(F.regexp_replace(decoded(line), r"[ \t]+", " "), r" ?\n[ \n]*", "\n")
        plain = ~(F.contains(line, F.lit("&")) | F.contains(line, F.lit("  ")) | F.contains(line, F.lit("\t")))
        return F.btrim(F.when(plain, line).otherwise(text), F.lit(" \n"))

    return F.array_join(F.filter(F.transform(F.split(bare, "\n", -1), tidy), lambda line: line != ""), "\n")


def bare_title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title", 1)


def title_of(bare: Column) -> Column:
    """Title of a page from :func:`bare_title`."""
    return F.regexp_replace(F.regexp_replace(decoded(bare), r"[ \t\r\n\f]+", " "), r"\A +| +\z", "")


def links_of(html: Column) -> Column:
    """Targets of links in order; line ends inside one become blanks."""
    found = F.regexp_extract_all(html, F.lit(r'(?i)<a\b[^>]*?\bhref="([^"]*)"'), F.lit(1))
    return F.transform(found, lambda u: F.translate(decoded(u), "\r\n", "  "))


def derive(responses_: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Two rows per response, a ``metadata`` and a ``conversion`` record: the ``keep`` columns, then
    ``record_type``, ``record_id``, ``refers_to`` (the response's id), ``target_uri``, ``date``,
    ``content_type``, ``payload_digest`` (the response's), ``block_digest``, ``content_length`` (bytes of UTF-8)
    and ``content``.

    A metadata record has, as WARC fields, the source's status line and headers as they were, the title,
    and the links; a conversion record the page's text. All character references that
    :func:`functions.text.decode_entities` knows are decoded. Ids follow from the response's id, so records of
    both kinds can be joined with it and found again. A NULL block counts as empty. Records are made row
    by row, repeated responses give repeated records, further columns are ignored.
    """
    block = F.coalesce(F.col("block"), F.lit(""))
    split = responses_.select(*[col(k) for k in keep], *[F.col(c) for c in RESPONSE if c != "block"], head_of(block).alias("_nm_head"), payload_of(block).alias("_nm_html"))
    # Decoding looks at a text several times: as columns of their own the texts are made once a row.
    split = split.withColumns({"_nm_bare": bare_text(F.col("_nm_html")), "_nm_title": bare_title(F.col("_nm_html"))})
    links = F.transform(links_of(F.col("_nm_html")), lambda u: F.concat(F.lit("outlink: "), u, F.lit(CRLF)))
    source = F.transform(F.split("_nm_head", CRLF, -1), lambda line: F.concat(F.lit("source-header: "), line, F.lit(CRLF)))
    fields = F.concat(F.array_join(source, ""), F.lit("title: "), title_of(F.col("_nm_title")), F.lit(CRLF), F.array_join(links, ""))
    kinds = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("content")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), plain_text(F.col("_nm_bare")).alias("content")),
    )
    both = split.withColumn("_nm_kind", F.explode(kinds))
    content = F.col("_nm_kind.content")
    return both.select(
        *[col(k) for k in keep], F.col("_nm_kind.record_type").alias("record_type"), urn(F.col("_nm_kind.record_type"), F.col("record_id")).alias("record_id"),
        F.col("record_id").alias("refers_to"), "target_uri", "date", F.col("_nm_kind.content_type").alias("content_type"), "payload_digest",
        digest(content).alias("block_digest"), F.octet_length(content).cast("long").alias("content_length"), content.alias("content"),
    )


def record(records: DataFrame) -> Column:
    """A record as it stands in a file, without the two line ends after it; absent headers are left out."""
    headers = [
        ("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"),
        ("WARC-Payload-Digest", "payload_digest"), ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length"),
    ]
    present = [(n, c) for n, c in headers if c in records.columns]
    lines = [F.coalesce(F.concat(F.lit(f"{CRLF}{n}: "), F.translate(F.col(c).cast("string"), CRLF, "  ")), F.lit("")) for n, c in present]
    return F.concat(F.lit(_MARK), *lines, F.lit(CRLF * 2), F.coalesce("content", F.lit("")))


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """``records`` as WARC files, one per partition."""
    records.select(record(records).alias("value")).write.option("lineSep", CRLF * 2).option("compression", compression).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of files written by :func:`write`: ``headers`` (a map), ``content`` and ``whole``, which tells
    whether the content has its stated length."""
    body = spark.read.option("lineSep", CRLF * 2 + _MARK + CRLF).text(path).select(F.regexp_replace("value", rf"\A{_MARK}\r\n|\r\n\r\n\z", "").alias("value")).where("value <> ''")
    at = F.instr("value", CRLF * 2)
    head = F.when(at > 0, F.substr("value", F.lit(1), at - 1)).otherwise(F.col("value"))
    entries = F.transform(F.split(head, CRLF), lambda line: F.struct(F.substring_index(line, ": ", 1).alias("key"), F.substr(line, F.instr(line, ": ") + 2).alias("value")))
    content = F.when(at > 0, F.substr("value", at + 4)).otherwise(F.lit(""))
    rows = body.select(F.map_from_entries(entries).alias("headers"), content.alias("content"))
    return rows.withColumn("whole", F.element_at("headers", "Content-Length").try_cast("long") == F.octet_length("content"))


def _sql() -> str:
    html = "html"
    for pattern in _DROPPED:
        html = f"regexp_replace({html}, '{pattern}', ' ', 'g')"
    html = f"regexp_replace({html}, '[ \\t\\r\\n\\f]+', ' ', 'g')"
    html = f"regexp_replace({html}, '(?i)</?({_LINE_TAGS})\\b[^>]*>', chr(10), 'g')"
    reference = r"'&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});'"
    names = ", ".join(f"'{name}': chr({code})" for name, code in sorted(name2codepoint.items()))
    number = "CASE WHEN p[2][2] IN ('x', 'X') THEN ('0' || lower(p[2][2:]))::BIGINT ELSE p[2][2:]::BIGINT END"

    def plain(text: str) -> str:
        found = f"list_zip(regexp_split_to_array(z, {reference}), regexp_extract_all(z, {reference}, 1))"
        one = f"CASE WHEN p[2] IS NULL THEN '' WHEN p[2][1] = '#' THEN chr(({number})::INTEGER) ELSE coalesce(names[p[2]], '&' || p[2] || ';') END"
        return f"list_transform([replace({text}, '&nbsp;', ' ')], lambda z: array_to_string(list_transform({found}, lambda p: p[1] || {one}), ''))[1]"

    text = plain(f"regexp_replace({html}, '<[^>]*>', '', 'g')")
    text = f"regexp_replace(regexp_replace({text}, '[ \\t]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g')"
    text = f"regexp_replace({text}, '^[ \\n]+|[ \\n]+$', '', 'g')"
    title = f"trim(regexp_replace({plain('regexp_extract(html, $t$(?is)<title[^>]*>(.*?)</title$t$, 1)')}, '[ \\t\\r\\n\\f]+', ' ', 'g'), ' ')"
    link = f"translate({plain('u')}, chr(13) || chr(10), '  ')"
    uuid = "'<urn:uuid:' || substr({0}, 1, 8) || '-' || substr({0}, 9, 4) || '-' || substr({0}, 13, 4) || '-' || substr({0}, 17, 4) || '-' || substr({0}, 21, 12) || '>'"
    return f"""
WITH m AS (SELECT MAP {{{names}, 'apos': chr(39)}} AS names),
b AS (SELECT page_id, url AS target_uri, coalesce(html, '') AS html, chr(13) || chr(10) AS nl FROM pages),
r AS (SELECT *, 'sha256:' || sha256(html) AS payload_digest, md5('response' || chr(10) || coalesce(page_id::VARCHAR, '') || chr(10) || coalesce(target_uri, '') || chr(10) || 'sha256:' || sha256(html)) AS h FROM b),
s AS (SELECT *, {uuid.format('h')} AS refers_to FROM r, m),
c AS (
  SELECT page_id, target_uri, payload_digest, refers_to, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
    'source-header: HTTP/1.1 200 OK' || nl || 'source-header: Content-Type: text/html; charset=utf-8' || nl || 'source-header: Content-Length: ' || strlen(html)::VARCHAR || nl
      || 'title: ' || {title} || nl
      || array_to_string(list_transform(regexp_extract_all(html, '(?i)<a\\b[^>]*?\\bhref="([^"]*)"', 1), lambda u: 'outlink: ' || {link} || nl), '') AS content
  FROM s
  UNION ALL
  SELECT page_id, target_uri, payload_digest, refers_to, 'conversion', 'text/plain; charset=utf-8', {text} FROM s
), d AS (SELECT *, md5(record_type || chr(10) || refers_to) AS h FROM c)
SELECT page_id, record_type, {uuid.format('h')} AS record_id, refers_to, target_uri, '2026-01-01T00:00:00Z' AS date, content_type, payload_digest,
  'sha256:' || sha256(content) AS block_digest, strlen(content)::BIGINT AS content_length, content
FROM d
"""


SQL = _sql()
