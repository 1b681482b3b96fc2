"""A stored index of all three-character substrings, so that a keyword search reads the texts of candidates only."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.columns import col, present
from newsmill.columns import text as as_text
from newsmill.operators.search import KEYWORD_COLUMNS, keyword_search
from newsmill.session import cut

# Buckets of the postings by substring, parts of each by key, and parts of the texts by key.
BUCKETS, SPREAD, TEXT_PARTS = 32, 4, 64
# Candidates up to which their keys go into the filter on the texts.
NAMED_KEYS = 1_000
GRAM = 3
# Texts, and bytes of them, whose postings are put together before they are sent.
SLICE_ROWS, SLICE_BYTES = 1_024, 8 << 20


def codes_of(text: str) -> np.ndarray:
    """The substrings of ``GRAM`` characters as numbers, 21 bits a character; none are alike for two substrings."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    n = max(0, len(points) - GRAM + 1)
    return sum((points[k : k + n] << (21 * k) for k in range(GRAM)), np.zeros(n, np.int64))


def _posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each substring of a slice of texts, with the keys of those that hold it."""
    for batch in batches:
        filled = np.cumsum(pc.binary_length(batch.column("body")).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE_BYTES
        starts = sorted({*range(0, batch.num_rows, SLICE_ROWS), *(np.flatnonzero(np.diff(filled)) + 1).tolist()})
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            part = batch.slice(start, end - start)
            found = [np.unique(codes_of(body.decode("utf-8", "replace"))) for body in part.column("body").to_pylist()]
            grams, rows = np.concatenate(found), np.repeat(np.arange(len(found)), [len(g) for g in found])
            order = np.argsort(grams, kind="stable")
            grams, first = np.unique(grams[order], return_index=True)
            keys = part.column("key").take(pa.array(rows[order]))
            ends = pa.array(np.append(first, len(order)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.ListArray.from_arrays(ends, keys)], names=["gram", "keys"])


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def _part(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(TEXT_PARTS)).cast("int")


def create(df: DataFrame, path: str, fields: Sequence[str] | None = None, key: str = "record_id") -> None:
    """Writes the rows to ``path/texts``, by ranges of keys within parts, and to ``path/postings`` lists of the keys whose
    lower-cased searched fields hold a substring, by substring. A substring has a list for each slice of texts that are
    read together, so that one that all rows have is dealt to several lists and tasks."""
    texts = df.withColumn("_nm_part", _part(col(key))).repartition("_nm_part").sortWithinPartitions("_nm_part", key)
    texts.write.mode("errorifexists").partitionBy("_nm_part").parquet(f"{path}/texts")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/texts")
    names = list(fields) if fields else present(df, KEYWORD_COLUMNS)
    body = F.lower(F.concat_ws(" ", *[F.coalesce(as_text(stored, f), F.lit("")) for f in names]))
    schema = T.StructType([T.StructField("gram", T.LongType()), T.StructField("keys", T.ArrayType(df.schema[key].dataType))])
    postings = stored.select(col(key).alias("key"), body.cast("binary").alias("body")).mapInArrow(_posted, schema).withColumn("bucket", _bucket(F.col("gram")))
    laid = postings.repartition("bucket", F.pmod(F.xxhash64(F.lit(1), F.col("keys")[0]), F.lit(SPREAD))).sortWithinPartitions("bucket", "gram")
    laid.write.mode("errorifexists").partitionBy("bucket").parquet(f"{path}/postings")


def candidates(spark: SparkSession, path: str, query: str) -> DataFrame | None:
    """Keys of rows that may contain a term of the query: those that have all substrings of one. None where a term is
    too short to have any: then every row is a candidate."""
    terms = sorted(set(re.split(r"\s+", query.strip().lower())))
    if any(len(t) < GRAM for t in terms):
        return None
    by_term = {t: sorted(set(codes_of(t).tolist())) for t in terms}
    wanted = sorted({g for grams in by_term.values() for g in grams})
    buckets = [r[0] for r in spark.createDataFrame([(g,) for g in wanted], "gram bigint").select(_bucket(F.col("gram"))).distinct().collect()]
    postings = spark.read.parquet(f"{path}/postings").where(F.col("bucket").isin(buckets) & F.col("gram").isin(wanted)).select("gram", F.explode("keys").alias("key"))
    held = postings.groupBy("key").agg(*[F.count_if(F.col("gram").isin(grams)).alias(f"n{k}") for k, grams in enumerate(by_term.values())])
    complete = F.lit(False)
    for k, grams in enumerate(by_term.values()):
        complete = complete | (F.col(f"n{k}") == len(grams))
    return held.where(complete).select("key")


def texts_to_read(spark: SparkSession, path: str, query: str, key: str = "record_id") -> DataFrame:
    """The stored rows that may match. The parts (and, if they are few, the keys) of the candidates reach the scan."""
    texts = spark.read.parquet(f"{path}/texts")
    found = candidates(spark, path, query)
    if found is None:
        return texts.drop("_nm_part")
    found = cut(found)
    parts = [r[0] for r in found.select(_part(F.col("key"))).distinct().collect()]
    rows = texts.where(F.col("_nm_part").isin(parts))
    some = [r[0] for r in found.limit(NAMED_KEYS + 1).collect()]
    if len(some) <= NAMED_KEYS:
        return rows.where(col(key).isin(some)).drop("_nm_part")
    return rows.join(found.withColumnRenamed("key", key), key, "left_semi").drop("_nm_part")


def search(spark: SparkSession, path: str, query: str, n: int = 10, key: str = "record_id", fields: Sequence[str] | None = None, **options) -> DataFrame:
    """As :func:`newsmill.operators.search.keyword_search` over the whole table. ``fields`` are those of the index."""
    return keyword_search(texts_to_read(spark, path, query, key), query, fields, n, key, **options)
