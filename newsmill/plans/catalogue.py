"""All registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsmill.plans import (  # noqa: F401
    queries_aggregate,
    queries_clean,
    queries_ingest,
    queries_reshape,
    queries_search,
    queries_select,
    queries_stream,
)
from newsmill.plans import queries_gaps, queries_stored  # noqa: F401  # restate some of the above

from newsmill.plans.registry import CATALOGUE


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly summary of the dated articles."""
    return CATALOGUE["yearly_summary"].run(spark, folder)


__all__ = ["CATALOGUE", "flagship"]
