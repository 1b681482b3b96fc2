"""File readers. Schemas are given, not inferred, so that a read is one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.columns import col
from newsmill.functions import dates
from newsmill.functions import text as tx
from newsmill.functions.text import NA_TOKENS, decode_bytes
from newsmill.operators.ingest import ARTICLE_PAGE, unnest_articles

# Columns read as dates.
DATE_COLUMNS = ["published_date", "release_date", "fetched_at", "extraction_timestamp"]


def _raw_csv(spark: SparkSession, path: str, names: Sequence[str], multi_line: bool) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    # The default empty value would turn "" into NULL before the token list sees it.
    return spark.read.csv(path, schema=schema, header=True, multiLine=multi_line, quote='"', escape='"', emptyValue="", enforceSchema=True)


def read_csv(
    spark: SparkSession, path: str, types: Mapping[str, str], date_formats: Sequence[str] = (), na: Sequence[str] = NA_TOKENS, multi_line: bool = False
) -> DataFrame:
    """Nine tokens count as NULL, the four date columns and the typed columns are read leniently.

    ``types`` names every column of the file in order. ``multi_line`` lets quoted fields hold line
    ends; files are then no longer split.
    """
    raw = _raw_csv(spark, path, list(types), multi_line)
    kept = raw.select(*[F.when(~col(n).isin(list(na)), col(n)).alias(n) for n in types])
    out = []
    for n, t in types.items():
        if n in DATE_COLUMNS:
            out.append(dates.parsed(kept, n, date_formats).alias(n))
        else:
            out.append((col(n) if t == "string" else tx.strip(col(n)).try_cast(t)).alias(n))
    return kept.select(*out)


def read_tagged_csv(spark: SparkSession, path: str, names: Sequence[str], multi_line: bool = False) -> DataFrame:
    """CSV rows as text with their kind, file and read time."""
    return _raw_csv(spark, path, names, multi_line).select(
        "*", F.lit("csv").alias("document_type"), F.col("_metadata.file_name").alias("file_name"), F.current_timestamp().alias("extraction_timestamp")
    )


def read_article_pages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Articles of a folder of API pages. One page per file by default; ``multi_line=False`` reads
    one page per line, which Spark can split."""
    pages = spark.read.schema(ARTICLE_PAGE).json(path, multiLine=multi_line, mode="PERMISSIVE")
    tagged = pages.select("*", F.col("_metadata.file_name").alias("file_name"), F.current_timestamp().alias("extraction_timestamp"))
    return unnest_articles(tagged, ["file_name", "extraction_timestamp"])


def read_article_fields(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Every field of the articles; unreadable pages give no row."""
    pages = spark.read.schema(ARTICLE_PAGE).json(path, multiLine=multi_line, mode="PERMISSIVE")
    return pages.select(F.inline("articles"))


def read_xml_rows(spark: SparkSession, path: str, row: str = "article", fields: Sequence[str] = ("id", "title", "category")) -> DataFrame:
    """One row per ``row`` element; an absent child is NULL."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    rows = spark.read.format("xml").schema(schema).option("rowTag", row).load(path)
    return rows.select("*", F.lit("xml").alias("document_type"), F.col("_metadata.file_name").alias("file_name"), F.current_timestamp().alias("extraction_timestamp"))


def read_json_objects(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """JSON objects by a given schema; ``is_bad`` marks those that cannot be read."""
    full = T.StructType.fromDDL(schema).add("_corrupt_record", T.StringType())
    rows = spark.read.schema(full).json(path, mode="PERMISSIVE", multiLine=multi_line, columnNameOfCorruptRecord="_corrupt_record")
    return rows.withColumn("is_bad", F.col("_corrupt_record").isNotNull()).drop("_corrupt_record")


def read_whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with its whole text."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))


def read_decoded(spark: SparkSession, path: str, fallback: str = "iso-8859-1") -> DataFrame:
    """One row per file, decoded by byte-order mark, as UTF-8 where valid, else by ``fallback``."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), decode_bytes(F.col("content"), fallback).alias("text"))


def is_file(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).isFile(hadoop_path)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def with_fallback(primary, secondary) -> DataFrame:
    """The primary source, or the secondary where the primary cannot be read or is empty. Both are
    calls without arguments that return a frame."""
    try:
        df = primary()
        if not df.isEmpty():
            return df
    except (PySparkException, Py4JError, OSError, ValueError):
        pass
    return secondary()
