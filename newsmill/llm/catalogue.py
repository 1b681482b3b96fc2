"""The registered queries of the corpus operators, with SQL where it can state the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.llm import chat, compression_rules, compression_score, decontaminate, disclosure, divergence, packing, phrases, sharding, toxicity, url_filter, warc
from newsmill.llm.near_duplicates import near_duplicates
from newsmill.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


@_query("op1_spaced_seed_decontamination")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("row_key")


@_query("op2_compression_classifier")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return compression_score.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_query("op3_permutation_sharding")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(table(spark, folder, "documents"), [f"shard-{k:03d}" for k in range(256)])


@_query("op4_sum_of_squares_packing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pieces(table(spark, folder, "documents"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


@_query("op5_compression_bands")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    judged = compression_rules.judge(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "n_chunks", "n_bad_chunks")


@_query("op6_perspective_rotation", chat.SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return chat.rotate(table(spark, folder, "conversations"))


@_query("op7_blocked_bloom_url_filter", url_filter.SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return url_filter.judge(pages, url_filter.listed_pages(pages))


@_query("op8_warc_derivatives", warc.SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, folder, "pages"), "2026-01-01T00:00:00Z"), keep=["page_id"])


@_query("op9_disclosure_sanitisation")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return disclosure.counts(disclosure.find(table(spark, folder, "documents")))


@_query("op10_minhash_near_duplicates")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return near_duplicates(docs, words=3, percent=85).select("doc_id", F.col("n_shingles").cast("long"), "component_id", "kept")


@_query("op11_non_negative_toxicity")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_query("op12_fingerprint_collocations", phrases.SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents")).drop("doc_id", "at")


@_query("op13_source_divergence", divergence.SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))
