"""Quantified answers to six fixed questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.functions.numbers import half_even

# Questions, answer forms and metric names.
Q_VALUE = "Which news category has the highest total estimated value?"
A_VALUE = "The highest total estimated value belongs to '%s' with %.2f total estimated value across %d records."
Q_RATING = "Which category has the highest average rating score?"
A_RATING = "The category with the highest average rating score is '%s' with an average rating score of %.2f."
Q_TYPE = "Which document type appears most often in the dataset?"
A_TYPE = "The most frequent document type is '%s' with %d records."
Q_RECORD = "Which individual record has the highest estimated value?"
A_RECORD = "The record with the highest estimated value is '%s' (record_id=%s) with %.2f estimated value."
Q_YEAR = "Which year has the most dated news records?"
A_YEAR = "The year with the most dated records is %d, with %d dated records."
Q_LEADERS = "How many top category-level records were identified?"
A_LEADERS = "The top-N category analysis identified %d leading records across categories."


def _best(df: DataFrame, by: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(by), *[col(t) for t in ties]).limit(1)


def _answer(row: DataFrame, question: str, form: str, values: Sequence[Column], metric: str, value: Column, support: Column) -> DataFrame:
    return row.select(
        F.lit(question).alias("question"),
        F.format_string(form, *values).alias("answer"),
        F.lit(metric).alias("main_metric"),
        half_even(value).alias("metric_value"),
        support.cast("bigint").alias("supporting_count"),
    )


def questions(df: DataFrame, key: str = "record_id") -> DataFrame:
    """One row per question, from rows prepared by ``insight_rows``. Ties go to the smallest
    label. The category questions need sums only, so no group is gathered."""
    categories = df.where("primary_category IS NOT NULL").groupBy("primary_category").agg(
        F.count(col(key)).alias("n"), F.sum("estimated_value").alias("total"), F.avg("rating_score").alias("rating")
    )
    types = df.groupBy("analysis_document_type").agg(F.count(col(key)).alias("n"))
    years = df.where("analysis_year IS NOT NULL").groupBy("analysis_year").agg(F.count(col(key)).alias("n"))
    n, one = F.col("n"), F.lit(1)
    parts = [
        _answer(_best(categories, "total", "primary_category"), Q_VALUE, A_VALUE, [F.col("primary_category"), F.col("total"), n], "total_estimated_value", F.col("total"), n),
        _answer(_best(categories, "rating", "primary_category"), Q_RATING, A_RATING, [F.col("primary_category"), F.col("rating")], "avg_rating_score", F.col("rating"), n),
        _answer(_best(types, "n", "analysis_document_type"), Q_TYPE, A_TYPE, [F.col("analysis_document_type"), n], "article_count", n, n),
        _answer(
            _best(df, "estimated_value", key), Q_RECORD, A_RECORD,
            [F.col("analysis_title"), col(key).cast("string"), F.col("estimated_value").cast("double")], "estimated_value", F.col("estimated_value"), one,
        ),
        _answer(_best(years, "n", "analysis_year"), Q_YEAR, A_YEAR, [F.col("analysis_year"), n], "article_count_by_year", n, n),
        # One leading record per category.
        _answer(categories.agg(F.count(one).alias("n")).where("n > 0"), Q_LEADERS, A_LEADERS, [n], "top_records_per_category", n, n),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
