"""From semi-structured records to tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.columns import col, present
from newsmill.columns import text as as_text
from newsmill.functions import text as tx
from newsmill.operators.ordering import group_position, keep_first, prefix_sum

# Envelope fields that are copied where the payload lacks them.
ENVELOPE_FIELDS = ["document_type", "file_name", "page_number", "extraction_timestamp", "extraction_library", "type"]

ARTICLE_PAGE = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("totalResults", T.LongType()),
        T.StructField(
            "articles",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("source", T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])),
                        *[T.StructField(n, T.StringType()) for n in ("author", "title", "description", "url", "urlToImage", "publishedAt", "content")],
                    ]
                )
            ),
        ),
    ]
)

# Row and cell patterns of a table whose rows and cells carry class names.
TEAM_ROW = rf"(?is)<tr\b[^>]*{tx.with_class('team')}[^>]*>(.*?)</tr>"
LINK_ROW = r"(?is)<li[^>]*>(.*?)</li>"


def class_cell(name: str) -> str:
    return rf"(?is)<td\b[^>]*{tx.with_class(name)}[^>]*>(.*?)</td>"


TEAM_CELLS = {n: class_cell(n) for n in ("name", "year", "wins", "losses")}
LINK_CELLS = {"href": rf"(?is)<a\b[^>]*{tx.attribute_value('href')}", "label": r"(?is)<a[^>]*>(.*?)</a>"}


def _envelope_columns(df: DataFrame, payload: Mapping[str, Column]) -> list[Column]:
    fixed = {"source_path": "source", "fetched_at": "fetched_at", "version": "version"}
    out = [col(f).alias(name) for name, f in fixed.items() if f in df.columns]
    for name in present(df, ENVELOPE_FIELDS):
        value = F.coalesce(payload[name], col(name).cast("string")) if name in payload else col(name)
        out.append(value.alias(name))
    return out


def flatten_envelopes(df: DataFrame, data: str = "data") -> DataFrame:
    """Payload fields to columns, the envelope's own fields beside them. A struct ``source`` in the
    payload gives ``source_id`` and ``source_name``; a payload that is no struct is the text."""
    dtype = df.schema[data].dataType
    if not isinstance(dtype, T.StructType):
        return df.select(F.coalesce(as_text(df, data), F.lit("")).alias("content_text"), *_envelope_columns(df, {}))
    payload: dict[str, Column] = {}
    for f in dtype.fields:
        value = F.col(f"`{data}`.`{f.name}`")
        if f.name != "source":
            payload[f.name] = value
        elif isinstance(f.dataType, T.StructType):
            payload["source_id"] = value.getField("id")
            payload["source_name"] = value.getField("name")
        else:
            payload["source_name"] = value
    envelope = set(present(df, ENVELOPE_FIELDS))
    own = {n: c for n, c in payload.items() if n not in envelope}
    return df.select(*[c.alias(n) for n, c in own.items()], *_envelope_columns(df, payload))


def flatten_variant(df: DataFrame, fields: Mapping[str, str], data: str = "data") -> DataFrame:
    """As :func:`flatten_envelopes` for a VARIANT payload: ``fields`` maps each wanted payload
    field to its type, and a field that is absent or of another type is NULL."""
    payload = {n: F.try_variant_get(col(data), f"$.{n}", t) for n, t in fields.items()}
    payload["source_id"] = F.try_variant_get(col(data), "$.source.id", "string")
    payload["source_name"] = F.coalesce(F.try_variant_get(col(data), "$.source.name", "string"), F.try_variant_get(col(data), "$.source", "string"))
    envelope = set(present(df, ENVELOPE_FIELDS))
    own = {n: c for n, c in payload.items() if n not in envelope}
    return df.select(*[c.alias(n) for n, c in own.items()], *_envelope_columns(df, payload))


def unnest_articles(pages: DataFrame, lineage: Sequence[str] = ()) -> DataFrame:
    """One row per article of an API page, with the source's name lifted."""
    a = F.col("_nm_a")
    fields = [a.getField(n).alias(n) for n in ("author", "title", "description", "url", "publishedAt")]
    exploded = pages.select(F.explode("articles").alias("_nm_a"), *[col(c) for c in lineage])
    return exploded.select(a.getField("source").getField("name").alias("source"), *fields, F.lit("json").alias("document_type"), *[col(c) for c in lineage])


def first_text(df: DataFrame, names: Sequence[str], fallback: Column) -> Column:
    """The first non-blank of several texts, else the fallback."""
    return F.coalesce(*[tx.non_blank(as_text(df, n)) for n in present(df, names)], fallback)


def html_rows(df: DataFrame, html: str, row: str, cells: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per match of the row pattern with the text of each cell, character references decoded; an
    absent cell is ''."""
    found = df.select(*[col(k) for k in keep], F.posexplode(F.regexp_extract_all(col(html), F.lit(row), F.lit(1))).alias("position", "_nm_row"))
    texts = {n: tx.strip(tx.decode_entities(F.regexp_replace(F.regexp_extract("_nm_row", p, 1), "<[^>]*>", ""))) for n, p in cells.items()}
    return found.select(*[col(k) for k in keep], "position", *[c.alias(n) for n, c in texts.items()])


def json_records(df: DataFrame, payload: str, schema: str, defaults: Mapping[str, object], keep: Sequence[str] = ()) -> DataFrame:
    """Rows of a JSON array column; absent fields take their default."""
    record = F.col("_nm_r")
    names = T.StructType.fromDDL(schema).names
    exploded = df.select(*[col(k) for k in keep], F.explode(F.from_json(col(payload), F.lit(f"array<struct<{_as_struct(schema)}>>"))).alias("_nm_r"))
    fields = [
        (F.coalesce(record.getField(n), F.lit(defaults[n])) if n in defaults else record.getField(n)).alias(n) for n in names
    ]
    return exploded.select(*[col(k) for k in keep], *fields)


def _as_struct(schema: str) -> str:
    return ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema).fields)


def image_links(df: DataFrame, order: str, link: str = "urlToImage", limit: int | None = None) -> DataFrame:
    """First article per image link, in order, with the file name the image would get. ``limit``
    is the number of images wanted."""
    linked = df.where(~tx.is_blank(col(link)))
    first = keep_first(linked, [col(link)], [col(order)])
    fallback = F.concat(F.lit("article_"), col(order).cast("string"), F.lit(".jpg"))
    named = first.withColumn("file_name", tx.file_name_from_url(col(link), fallback))
    return named.orderBy(order).limit(limit) if limit is not None else named


def shift_segments(segments: DataFrame, durations: DataFrame, file: str = "source_file", chunk: str = "chunk", width: int = 10_000) -> DataFrame:
    """Segment and word times moved by the summed durations of the earlier chunks of their file.

    ``durations`` has one row per file and chunk number. The result stays one row per segment, so
    a recording of any length is never gathered in one place.
    """
    offsets = prefix_sum(durations, [file], F.floor(col(chunk) / width), [col(chunk)], F.col("duration_s"), "_nm_earlier")
    offset = F.col("_nm_earlier")

    def moved(c: Column) -> Column:
        return F.bround(c + offset, 3)

    joined = segments.join(offsets.select(file, chunk, "_nm_earlier"), [file, chunk])
    shifted = joined.withColumns({"start": moved(F.col("start")), "end": moved(F.col("end"))})
    if "words" in segments.columns:
        fields = [f.name for f in segments.schema["words"].dataType.elementType.fields]

        def word(w: Column) -> Column:
            return F.struct(*[(moved(w.getField(f)) if f in ("start", "end") else w.getField(f)).alias(f) for f in fields])

        shifted = shifted.withColumn("words", F.transform("words", word))
    return shifted.drop("_nm_earlier")


def recording_summary(chunks: DataFrame, file: str = "source_file", chunk: str = "chunk") -> DataFrame:
    """Per recording: language of its first chunk, number of chunks, total duration."""
    return chunks.groupBy(file).agg(
        F.min_by("language", chunk).alias("language"),
        F.min_by("language_probability", chunk).alias("language_probability"),
        F.count(F.lit(1)).alias("total_chunks"),
        F.bround(F.sum("duration_s"), 2).alias("duration_s"),
    )


# What a transcript field holds when the recogniser gave none.
TRANSCRIPT_DEFAULTS = {"source_file": "", "model": "unknown", "language": "", "language_probability": 0.0, "duration_s": 0.0, "full_text": ""}


def transcript_envelope(df: DataFrame, source_path: Column, source_type: str = "audio", paths: Mapping[str, Column] | None = None) -> DataFrame:
    """The stored form of a transcript; the clock column is the caller's."""
    given = dict(paths or {})

    def field(name: str) -> Column:
        default = TRANSCRIPT_DEFAULTS[name]
        value = F.coalesce(col(name), F.lit(default)) if name in df.columns else F.lit(default)
        return value.alias(name)

    no_segments = F.array().cast("array<struct<start:double,end:double,text:string>>")
    segments = F.coalesce(F.col("segments"), F.array().cast(df.schema["segments"].dataType)) if "segments" in df.columns else no_segments
    return df.select(
        field("source_file"), source_path.alias("source_path"), F.lit(source_type).alias("source_type"), field("model"), field("language"),
        field("language_probability"), field("duration_s"),
        (col("total_chunks") if "total_chunks" in df.columns else F.lit(None).cast("bigint")).alias("total_chunks"),
        field("full_text"), segments.alias("segments"),
        *[given.get(p, F.lit(None).cast("string")).alias(f"transcript_{p}_path") for p in ("json", "txt", "srt")],
        F.lit("transcript").alias("type"),
    )


def cues(segments: DataFrame, file: str, order: str, width: int = 100_000) -> DataFrame:
    """Subtitle cues: number within the file, time line and text."""
    placed = group_position(segments, [file], order, "_nm_p", width)
    times = F.concat(tx.cue_time(F.col("start")), F.lit(" --> "), tx.cue_time(F.col("end")))
    return placed.select(col(file), (F.col("_nm_p") + 1).cast("bigint").alias("cue"), times.alias("times"), tx.strip(F.col("text")).alias("text"))


def text_runs(df: DataFrame, body: str = "text") -> DataFrame:
    """Runs with text, trimmed."""
    return df.where(~tx.is_blank(col(body))).withColumn(body, tx.strip(col(body)))


def sheet_rows(df: DataFrame, cells: Sequence[str]) -> DataFrame:
    """Rows that have at least one filled cell."""
    return df.dropna("all", subset=list(cells))


def key_values(df: DataFrame, sheet: str, key: str, value: str, order: str, keys: Sequence[str]) -> DataFrame:
    """Key/value rows to one wide row per sheet; the last value of a repeated key wins."""
    last = [F.max_by(F.when(col(key) == k, col(value)), F.when(col(key) == k, col(order))).alias(k) for k in keys]
    return df.where(col(key).isNotNull()).groupBy(col(sheet)).agg(*last)
