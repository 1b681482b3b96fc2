"""Stages of the corpus run: ``(spark, docs, sf_dir)`` to the rows that go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.llm import compression_rules, decontaminate, disclosure, packing
from newsmill.llm.near_duplicates import near_duplicates
from newsmill.session import table

# Names of helper columns that no table should have.
_ID, _TEXT, _OLD = "_nm_doc_id", "_nm_text_key", "_nm_old_text"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands reject go, empty ones with them."""
    return compression_rules.passing(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id; repeated rows of it
    go too. Rows without an id stay, and so do texts without words."""
    verdicts = near_duplicates(docs).where("kept").select(F.col("doc_id").alias(_ID), F.col("text_key").alias(_TEXT)).distinct()
    keyed = docs.withColumns({_TEXT: F.xxhash64("text"), _ID: F.col("doc_id")})
    kept = keyed.where(F.col(_ID).isNotNull()).join(verdicts.where(F.col(_ID).isNotNull()), [_ID, _TEXT], "left_semi")
    single = kept.dropDuplicates([_ID, _TEXT])
    return single.unionByName(keyed.where(F.col(_ID).isNull())).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with an item of ``benchmark`` go."""
    return decontaminate.clean_of(docs, decontaminate.overlaps(docs, table(spark, sf_dir, "benchmark")))


def sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, personal data and what reveals it is replaced; ``n_chars`` follows the new text."""
    clean = disclosure.sanitise(docs.withColumn(_OLD, F.col("text")))
    length = F.when(F.col("text").eqNullSafe(F.col(_OLD)), F.col("n_chars")).otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", length).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 1024 tokens."""
    pieces = packing.pieces(docs)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
