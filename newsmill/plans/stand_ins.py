"""The standard tables seen as articles, dated articles and measured articles, each with its SQL.

Prices are divided by 997, so that no mean of them ends on a rounding tie: two engines add doubles
in different orders, and a tie would show the last bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.functions.text import WHITE
from newsmill.session import table

ARTICLES_SQL = """articles AS (
  SELECT doc_id AS record_id, split_part(text, chr(10), 1) AS title, text AS content_text, source AS category,
         'doc_' || lang AS document_type, source AS source_name, lang AS language, n_chars AS content_length
  FROM documents)"""

RATED_SQL = """rated AS (
  SELECT d.doc_id AS record_id, split_part(d.text, chr(10), 1) AS title, d.text AS content_text, d.source AS category,
         'doc_' || d.lang AS document_type, d.source AS source_name, d.lang AS language, d.n_chars AS content_length,
         CAST(l.quality * 7 + l.toxic * 2 AS DOUBLE) AS rating_score, CAST(l.toxic AS DOUBLE) AS mentions,
         CAST(d.n_chars AS DOUBLE) / 100 AS popularity
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

DATED_SQL = """dated AS (
  SELECT o_orderkey AS record_id, 'Order ' || o_orderkey AS title, o_orderpriority AS primary_category,
         o_orderstatus AS document_type, o_orderdate AS published_date, CAST(year(o_orderdate) AS INTEGER) AS analysis_year,
         o_totalprice / 50000 AS rating_score, o_totalprice / 997 AS estimated_value, o_totalprice / 99700 AS engagement_score,
         CAST(o_custkey AS DOUBLE) AS popularity, o_custkey AS content_length
  FROM orders)"""

MEASURED_SQL = """measured AS (
  SELECT l_orderkey AS record_id, l_returnflag AS primary_category, l_linestatus AS document_type, l_quantity AS rating_score,
         l_discount AS popularity, l_linenumber AS content_length, l_tax / 997 AS engagement_score, l_extendedprice / 997 AS estimated_value
  FROM lineitem)"""

# Literals for the SQL side: trimmed characters, and the same set inside a character class.
SQL_WHITE = "'" + WHITE + "'"
SQL_WS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SQL_WORD = r"\p{L}\p{N}_"


def articles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("record_id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("content_text"),
        F.col("source").alias("category"),
        F.concat(F.lit("doc_"), "lang").alias("document_type"),
        F.col("source").alias("source_name"),
        F.col("lang").alias("language"),
        F.col("n_chars").alias("content_length"),
    )


def rated(spark: SparkSession, folder: str) -> DataFrame:
    """Articles with the gaps of an incomplete rating table."""
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("record_id"),
        (F.col("quality") * 7 + F.col("toxic") * 2).cast("double").alias("rating_score"),
        F.col("toxic").cast("double").alias("mentions"),
    )
    joined = articles(spark, folder).join(labels, "record_id", "left")
    return joined.withColumn("popularity", F.col("content_length").cast("double") / 100)


def dated(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("record_id"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_orderpriority").alias("primary_category"),
        F.col("o_orderstatus").alias("document_type"),
        F.col("o_orderdate").alias("published_date"),
        F.year("o_orderdate").alias("analysis_year"),
        (F.col("o_totalprice") / 50000).alias("rating_score"),
        (F.col("o_totalprice") / 997).alias("estimated_value"),
        (F.col("o_totalprice") / 99700).alias("engagement_score"),
        F.col("o_custkey").cast("double").alias("popularity"),
        F.col("o_custkey").alias("content_length"),
    )


def measured(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("record_id"),
        F.col("l_returnflag").alias("primary_category"),
        F.col("l_linestatus").alias("document_type"),
        F.col("l_quantity").alias("rating_score"),
        F.col("l_discount").alias("popularity"),
        F.col("l_linenumber").alias("content_length"),
        (F.col("l_tax") / 997).alias("engagement_score"),
        (F.col("l_extendedprice") / 997).alias("estimated_value"),
    )


def rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    """Sums of doubles depend on their order in the last bits; rounded for comparison."""
    return df.withColumns({n: F.round(n, places) for n in names})
