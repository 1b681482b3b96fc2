"""A cleaning run for a training corpus: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsmill.llm import stages
from newsmill.session import scratch_path, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", stages.quality),
    ("near_duplicates", stages.deduplicate),
    ("decontamination", stages.decontaminated),
    ("personal_data", stages.sanitised),
    ("packing", stages.packed),
]

# SQL cannot state MinHash, zstandard or the tokenizer; the tests compare the run with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; what lies between them is in the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
