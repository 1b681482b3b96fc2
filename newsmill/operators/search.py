"""Keyword search, exact vector search and rank fusion."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.columns import col, is_floating, number, present
from newsmill.columns import text as as_text
from newsmill.functions import text as tx
from newsmill.operators.joins import only_new
from newsmill.operators.ordering import keep_first
from newsmill.operators.select import matching

# Searched fields, and the length caps of the stored metadata.
KEYWORD_COLUMNS = [
    "title", "content_text", "overview", "description", "text", "processed_text", "raw_text",
    "category", "document_type", "source_name",
]
METADATA_LENGTHS = {"title": 500, "category": 100, "document_type": 100, "source_name": 200, "language": 20}
METADATA_DEFAULTS = {"title": "Untitled"}
RRF_K = 60
NO_DOCUMENT = "Unknown news document"

# Queries that one pass over the vectors answers; more are answered block by block.
QUERY_BLOCK = 1024


def searchable_text(df: DataFrame) -> Column:
    names = ["title", "content_text", "overview", "description", "category", "genres", "document_type", "source_name", "language"]
    return tx.search_text({n: as_text(df, n) for n in present(df, names)})


def metadata(df: DataFrame, key: str = "record_id") -> DataFrame:
    """Id, searchable text and typed, length-capped metadata for a search table."""

    def label(name: str) -> Column:
        default = F.lit(METADATA_DEFAULTS.get(name, tx.UNKNOWN))
        value = F.coalesce(as_text(df, name), default) if name in df.columns else default
        return F.left(value, F.lit(METADATA_LENGTHS[name]))

    def measure(name: str, cast: str) -> Column:
        value = number(df, name).cast("double") if name in df.columns else F.lit(None).cast("double")
        return F.coalesce(value.try_cast(cast), F.lit(0).cast(cast))

    record = number(df, key).try_cast("bigint").cast("string")
    return df.select(
        F.concat(F.lit("record_"), F.coalesce(record, as_text(df, key), F.xxhash64(searchable_text(df)).cast("string"))).alias("id"),
        searchable_text(df).alias("document"),
        *[label(n).alias(n) for n in METADATA_LENGTHS],
        measure("published_year", "int").alias("year"),
        measure("rating_score", "double").alias("rating_score"),
        measure("popularity", "double").alias("popularity"),
        measure("content_length", "int").alias("content_length"),
    )


def keyword_search(
    df: DataFrame, query: str, fields: Sequence[str] | None = None, n: int = 10, key: str = "record_id", rating: str = "rating_score",
    keep: Sequence[str] = ("title", "category", "document_type", "published_year", "language", "rating_score"),
) -> DataFrame:
    """The ``n`` best rows by whole phrase, then by the number of query terms contained (as
    substrings; a repeated term counts again), then by rating, then by key."""
    phrase = query.strip().lower()
    names = list(fields) if fields else present(df, KEYWORD_COLUMNS)
    if not phrase or not names:
        return df.select(col(key)).where(F.lit(False))
    body = F.lower(F.concat_ws(" ", *[F.coalesce(as_text(df, f), F.lit("")) for f in names]))
    score = F.lit(0)
    for term in re.split(r"\s+", phrase):
        score = score + F.contains(F.col("_nm_body"), F.lit(term)).cast("int")
    kept = [k for k in keep if k in df.columns and k != key]
    found = (
        df.select(col(key), *[number(df, k).alias(k) if k == rating and is_floating(df, k) else col(k) for k in kept], body.alias("_nm_body"))
        .withColumns({"keyword_score": score, "phrase_match": F.contains(F.col("_nm_body"), F.lit(phrase))})
        .drop("_nm_body")
        .where(F.col("phrase_match") | (F.col("keyword_score") > 0))
    )
    order = [F.desc("phrase_match"), F.desc("keyword_score")]
    if rating in kept:
        order.append(F.desc_nulls_last(rating))
    order.append(col(key))
    best = found.orderBy(*order).limit(n)
    # At most ``n`` rows are ranked.
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("int"))
    return ranked.withColumn("search_type", F.lit("keyword"))


def nearest(
    df: DataFrame, queries: Mapping[str, Sequence[float]], k: int = 10, key: str = "id", vector: str = "embedding",
    keep: Sequence[str] = (), where: Mapping[str, Any] | None = None,
) -> DataFrame:
    """The ``k`` nearest rows by cosine for each query vector, exactly. Vectors of another width have no
    cosine and no rank; :func:`other_widths` lists them.

    Each Arrow batch is scored by one matrix product and keeps its ``k`` best rows per query (all
    rows level with the last one are weighed by key), so the shuffle carries only candidates.
    """
    if not queries:
        raise ValueError("at least one query is needed")
    names = list(queries)
    if len(names) > QUERY_BLOCK:
        blocks = [{q: queries[q] for q in names[i : i + QUERY_BLOCK]} for i in range(0, len(names), QUERY_BLOCK)]
        return reduce(DataFrame.unionAll, [nearest(df, b, k, key, vector, keep, where) for b in blocks])
    matrix = np.asarray([queries[q] for q in names], dtype="float64")
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    unit = np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)
    width = matrix.shape[1]
    kept = [key, *[c for c in keep if c != key]]
    source = matching(df, where).where(F.size(col(vector)) == width).select(*[col(c) for c in kept], col(vector).cast("array<float>").alias("_nm_v"))
    fields = [source.schema[c] for c in kept]
    schema = T.StructType([T.StructField("query", T.StringType()), *fields, T.StructField("similarity_score", T.DoubleType())])

    def best_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = batch.column("_nm_v").flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, width)
            size = np.linalg.norm(rows, axis=1, keepdims=True)
            scores = np.divide(rows @ unit.T, size, out=np.zeros((len(rows), len(names))), where=size > 0)
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            for q, name in enumerate(names):
                s = scores[:, q]
                pool = np.arange(len(s))
                if len(s) > k:
                    pool = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                pick = pool[np.lexsort((keys[pool], -s[pool]))][:k]
                taken = batch.select(kept).take(pa.array(pick))
                labels = pa.array([name] * len(pick), pa.string())
                yield pa.RecordBatch.from_arrays([labels, *taken.columns, pa.array(s[pick])], names=["query", *kept, "similarity_score"])

    candidates = source.mapInArrow(best_of, schema)
    ranked = keep_first(candidates, [F.col("query")], [F.desc("similarity_score"), col(key)], k, out="rank")
    return ranked.select(
        "query", "rank", *[col(c) for c in kept], (1 - F.col("similarity_score")).alias("distance"), "similarity_score"
    ).withColumn("search_type", F.lit("semantic"))


def other_widths(df: DataFrame, width: int, key: str = "id", vector: str = "embedding") -> DataFrame:
    """Key and width of the rows whose vector a query of ``width`` numbers cannot be compared with."""
    size = F.size(col(vector))
    return df.where(col(vector).isNull() | (size != width)).select(col(key), F.when(col(vector).isNotNull(), size).alias("width"))


def vector_search(df: DataFrame, query: Sequence[float], k: int = 10, **options: Any) -> DataFrame:
    """One query; see :func:`nearest`."""
    return nearest(df, {"q": query}, k, **options).drop("query")


def similarity_to(df: DataFrame, anchors: Mapping[str, Sequence[float]], key: str = "id", vector: str = "embedding") -> DataFrame:
    """Cosine of every row to each anchor vector, in long form; NULL where the widths differ."""
    if not anchors:
        raise ValueError("at least one anchor is needed")
    names = list(anchors)
    if len(names) > QUERY_BLOCK:
        blocks = [{a: anchors[a] for a in names[i : i + QUERY_BLOCK]} for i in range(0, len(names), QUERY_BLOCK)]
        return reduce(DataFrame.unionAll, [similarity_to(df, b, key, vector) for b in blocks])
    matrix = np.asarray([anchors[a] for a in names], dtype="float64")
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    unit = matrix / np.where(lengths == 0, 1, lengths)
    width = matrix.shape[1]
    source = df.where(F.size(col(vector)) == width).select(col(key), col(vector).cast("array<float>").alias("_nm_v"))
    schema = T.StructType([source.schema[key], T.StructField("cosines", T.ArrayType(T.DoubleType()))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("_nm_v").flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, width)
            size = np.linalg.norm(rows, axis=1, keepdims=True)
            cosines = (rows / np.where(size == 0, 1, size)) @ unit.T
            offsets = np.arange(0, cosines.size + 1, len(names), dtype="int32")
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(cosines.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(key), lists], names=[key, "cosines"])

    labels = F.array(*[F.lit(a) for a in names])
    zipped = F.arrays_zip(labels.alias("anchor"), F.col("cosines").alias("cosine"))
    unlike = other_widths(df, width, key, vector).select(col(key), F.explode(labels).alias("anchor"), F.lit(None).cast("double").alias("cosine"))
    return source.mapInArrow(score, schema).select(col(key), F.inline(zipped)).unionAll(unlike)


def fuse(keyword: DataFrame, semantic: DataFrame, key: str = "record_id", k: int = RRF_K) -> DataFrame:
    """Reciprocal-rank fusion of two ranked results that share a key of one type."""
    a = keyword.withColumnRenamed("rank", "keyword_rank").drop("search_type")
    b = semantic.withColumnRenamed("rank", "semantic_rank").drop("search_type")
    shared = [c for c in b.columns if c in set(a.columns) and c != key]
    both = a.join(b.drop(*shared), key, "full_outer")
    if shared:
        names = [c for c in shared]
        extra = b.select(col(key).alias("_nm_k"), *[col(c).alias(f"_nm_{c}") for c in names])
        both = both.join(extra, F.col("_nm_k") == col(key), "left")
        both = both.withColumns({c: F.coalesce(col(c), col(f"_nm_{c}")) for c in names}).drop("_nm_k", *[f"_nm_{c}" for c in names])

    def part(name: str) -> Column:
        return F.coalesce(F.lit(1.0) / (k + F.col(name)), F.lit(0.0))

    score = F.bround(part("keyword_rank") + part("semantic_rank"), 6)
    return both.withColumns({"rrf_score": score, "search_type": F.lit("hybrid")}).orderBy(F.desc("rrf_score"), col(key))


def hybrid_search(
    articles: DataFrame, vectors: DataFrame, query: str, query_vector: Sequence[float], n: int = 10, key: str = "record_id",
    k: int = RRF_K, where: Mapping[str, Any] | None = None, fields: Sequence[str] | None = None, vector: str = "embedding",
    keep: Sequence[str] = ("title", "category", "document_type", "published_year", "language", "rating_score"),
) -> DataFrame:
    """Three times ``n`` candidates from each method, fused, and the best ``n`` kept."""
    words = keyword_search(articles, query, fields, 3 * n, key, keep=keep)
    near = vector_search(vectors, query_vector, 3 * n, key=key, vector=vector, where=where)
    return fuse(words, near, key, k).limit(n)


def compare_methods(results: Mapping[str, DataFrame], key: str = "record_id") -> DataFrame:
    """Ranked keys of several methods for one query, stacked."""
    frames = [df.select(F.lit(name).alias("search_type"), col("rank").cast("int").alias("rank"), col(key)) for name, df in results.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def rows_to_index(stored: DataFrame, incoming: DataFrame, key: str = "id", document: str = "document") -> DataFrame:
    """Incoming rows that are not stored yet and have a real document."""
    usable = incoming.where((col(document) != "") & (col(document) != NO_DOCUMENT))
    return only_new(stored, usable, key)


def load_counts(stored: DataFrame, incoming: DataFrame, key: str = "id", document: str = "document") -> DataFrame:
    """Rows added and skipped by a load, and the rows stored after it."""
    added = rows_to_index(stored, incoming, key, document).agg(F.count(F.lit(1)).alias("v")).scalar()
    before = stored.agg(F.count(F.lit(1)).alias("v")).scalar()
    return incoming.agg(F.count(F.lit(1)).alias("n")).select(
        added.alias("added"), (F.col("n") - added).alias("skipped"), (before + added).alias("total")
    )
