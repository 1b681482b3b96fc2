"""Document and metrics tables kept as Parquet: scans, appends, upserts and reloads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.columns import col, is_floating, nan_to_null, number
from newsmill.columns import text as as_text
from newsmill.operators.ingest import flatten_envelopes
from newsmill.operators.joins import upsert

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.LongType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("primary_category", T.StringType()),
        T.StructField("document_type", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("published_date", T.TimestampType()),
        T.StructField("published_year", T.IntegerType()),
        T.StructField("rating_score", T.FloatType()),
        T.StructField("popularity", T.FloatType()),
        T.StructField("content_length", T.IntegerType()),
        T.StructField("title_length", T.IntegerType()),
        T.StructField("engagement_score", T.FloatType()),
        T.StructField("estimated_value", T.FloatType()),
    ]
)

# The most files that one facet of the serving table is written to.
FILES_PER_FACET = 16

_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def scan_documents(
    spark: SparkSession, path: str, equals: Mapping[str, Any] | None = None, limit: int = 0, flatten: bool = False,
    fmt: str = "parquet", schema: T.StructType | None = None,
) -> DataFrame:
    """Stored documents by equality filters, which reach a columnar scan. JSON stores take a
    schema, so that they are not read twice."""
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema else reader).load(path)
    for name, value in (equals or {}).items():
        df = df.where(col(name) == F.lit(value))
    if limit:
        df = df.limit(limit)
    return flatten_envelopes(df) if flatten else df


def scan_metrics(df: DataFrame, value: str = "estimated_value", at_least: float | None = None, then_by: Sequence[str] = ()) -> DataFrame:
    """Highest values first; the threshold reaches the scan. For a database, hand in a JDBC frame."""
    if at_least is not None:
        df = df.where((col(value) >= at_least) & (~F.isnan(col(value)) if is_floating(df, value) else F.lit(True)))
    return df.orderBy(number(df, value).desc_nulls_last(), *[col(t) for t in then_by])


def where_given(df: DataFrame, name: str, value: Any = None) -> DataFrame:
    """All rows, or those equal to a given value."""
    return df.where(col(name) == F.lit(value)) if value else df


def envelope(df: DataFrame, data: Column, source: Column, fetched_at: Column, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Records wrapped as versioned raw documents."""
    return df.select(
        data.alias("data"), source.alias("source"), fetched_at.alias("fetched_at"), F.lit(1).alias("version"),
        *[c.alias(n) for n, c in (extra or {}).items()],
    )


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a fixed schema, in its order and types; what does not fit is NULL."""
    return df.select(*[col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def create_table(spark: SparkSession, name: str, path: str, schema: T.StructType = METRICS_SCHEMA, reset: bool = False) -> None:
    """A Parquet table with a fixed schema at a path; ``reset`` drops the earlier definition."""
    if reset:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{path}'")


def load_table(df: DataFrame, name: str, path: str, schema: T.StructType = METRICS_SCHEMA) -> DataFrame:
    """Creates the table afresh, loads it and reads it back."""
    spark = df.sparkSession
    create_table(spark, name, path, schema, reset=True)
    conform(df, schema).write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def upsert_to(old: DataFrame, new: DataFrame, key: str, path: str, order: Sequence[str] = (), clear: bool = False) -> DataFrame:
    """Writes the upserted table to a path that ``old`` does not read from, and reads it back; the
    caller then points its readers to the new path. With ``clear`` the old rows all go."""
    merged = upsert(old.limit(0) if clear else old, new, key, order)
    merged.write.mode("errorifexists").parquet(path)
    return old.sparkSession.read.parquet(path)


def reload_serving(df: DataFrame, path: str, partition_by: Sequence[str] = ("category",)) -> DataFrame:
    """Replaces the serving table: NaN becomes NULL, files are laid out by facet, at most
    ``FILES_PER_FACET`` of each, so that a large facet is written by several tasks."""
    salt = F.pmod(F.xxhash64(*[as_text(df, n) for n in df.columns]), F.lit(FILES_PER_FACET))
    laid = nan_to_null(df).repartition(*[col(n) for n in partition_by], salt)
    laid.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_results(results: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> dict[str, str]:
    """Each result frame to its own sub-folder; returns the paths."""
    paths = {}
    for name, df in results.items():
        paths[name] = f"{folder}/{name}"
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer.csv(paths[name], header=True, quote='"', escape='"')
        else:
            writer.format(fmt).save(paths[name])
    return paths


def export_lines(df: DataFrame, path: str, file: str, order: Sequence[str], line: Column) -> None:
    """One text folder per ``file`` value, lines in order across its part files."""
    lines = df.select(col(file), line.alias("value"), *[col(o) for o in order])
    ranged = lines.repartitionByRange(col(file), *[col(o) for o in order]).sortWithinPartitions(file, *order)
    ranged.select(file, "value").write.mode("overwrite").partitionBy(file).text(path)


def exported_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines written by :func:`export_lines` as ``value``, with the column that names the folders.

    Spark lists folders in up to 10,000 tasks, most of whose time is not listing; here in four for each core.
    """
    before = spark.conf.get(_LISTING_TASKS)
    spark.conf.set(_LISTING_TASKS, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        return spark.read.text(path)
    finally:
        spark.conf.set(_LISTING_TASKS, before)
