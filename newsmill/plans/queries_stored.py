"""Stored tables that are written in part, laid out for several columns, profiled by chunk; many phrases in one pass."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsmill.operators.aggregates import distinct_counts
from newsmill.operators.phrasebook import phrase_counts
from newsmill.plans.registry import CATALOGUE, query
from newsmill.plans.stand_ins import articles, rounded
from newsmill.session import scratch_path, table
from newsmill.sources import buckets, layout, profiles


@query("upsert_in_place", 10, 14, sql=CATALOGUE["upsert"].sql)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "buckets")
    buckets.create(orders.where("o_orderstatus <> 'O'").drop("o_orderstatus").withColumn("seq", F.lit(0)), path, "o_orderkey", 16)
    new = orders.where("o_orderstatus <> 'F'")
    twice = new.select("o_orderkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("seq"), (F.col("o_totalprice") + F.col("seq")).alias("o_totalprice"))
    buckets.upsert_into(twice, path, ["seq"])
    return buckets.read(spark, path).drop("seq")


@query("clustered_table", 16, sql="SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders")
def _(spark, sf):
    path = scratch_path(spark, "clustered")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    layout.write_clustered(orders, path, ["o_custkey", "o_orderdate", "o_orderpriority"], 32)
    return spark.read.parquet(path)


_TOKENS = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"
_PAIRS_SQL = """(SELECT {key}, a || ' ' || c AS phrase FROM (
      SELECT *, lead(a, 1) OVER v AS b, lead(a, 2) OVER v AS c FROM (SELECT {key}, unnest(t) AS a, generate_subscripts(t, 1) AS pos FROM (SELECT {key}, regexp_extract_all(lower({text}), '{tokens}') AS t FROM {rows}))
      WINDOW v AS (PARTITION BY {key} ORDER BY pos)) WHERE b = ' ' AND regexp_matches(a, '{word}') AND regexp_matches(c, '{word}'))"""


def _pairs_sql(rows: str, key: str, text: str) -> str:
    return _PAIRS_SQL.format(rows=rows, key=key, text=text, tokens=_TOKENS, word=r"^[\p{L}\p{N}_]")


@query(
    "phrase_counts", 36, 92,
    sql=f"""WITH d AS {_pairs_sql('documents', 'doc_id', 'text')}, b AS {_pairs_sql('benchmark', 'item_id', 'text')}
    SELECT doc_id AS record_id, phrase, count(*) AS times FROM d WHERE phrase IN (SELECT phrase FROM b UNION SELECT lower(p_name) FROM part) GROUP BY ALL""",
)
def _(spark, sf):
    # All word pairs of the benchmark, and the names of the parts.
    tokens = F.regexp_extract_all(F.lower("text"), F.lit(_TOKENS), F.lit(0))
    word = lambda t: F.rlike(t, F.lit(r"^[\p{L}\p{N}_]"))
    items = table(spark, sf, "benchmark").select(tokens.alias("t")).where("size(t) > 2")
    at = items.select("t", F.explode(F.sequence(F.lit(0), F.size("t") - 3)).alias("k"))
    a, b, c = (F.get("t", F.col("k") + i) for i in range(3))
    pairs = at.where((b == " ") & word(a) & word(c)).select(F.concat(a, F.lit(" "), c).alias("phrase"))
    names = table(spark, sf, "part").select(F.col("p_name").alias("phrase"))
    return phrase_counts(articles(spark, sf), pairs.unionAll(names), "phrase")


@query(
    "chunk_profiles", 55, 58,
    sql="""WITH n AS (UNPIVOT (SELECT o_custkey::DOUBLE AS o_custkey, o_totalprice::DOUBLE AS o_totalprice FROM orders) ON o_custkey, o_totalprice INTO NAME "column" VALUE v)
    SELECT "column", count(*) AS rows, count(v) AS values, round(avg(v), 4) AS mean, min(v) AS low, max(v) AS high, true AS distinct_within_error, true AS median_within_error FROM n GROUP BY 1
    UNION ALL SELECT 'o_orderstatus', count(*), count(o_orderstatus), NULL, NULL, NULL, true, NULL FROM orders""",
)
def _(spark, sf):
    path = scratch_path(spark, "profiles")
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_custkey", "o_totalprice", "o_orderstatus")
    # The second load holds the chunks of the first one again.
    profiles.add_chunks(orders.where("o_orderpriority < '3'"), path, "o_orderpriority")
    profiles.add_chunks(orders, path, "o_orderpriority")
    found = profiles.profile(spark, path, [0.5])
    exact = distinct_counts(orders, ["o_custkey", "o_totalprice", "o_orderstatus"]).select("column", "nunique")
    near = F.abs(F.col("distinct") - F.col("nunique")) <= F.ceil(F.col("nunique") * profiles.DISTINCT_ERROR)
    medians = {r["column"]: r["q50"] for r in found.select("column", "q50").collect()}
    below = [F.struct(F.lit(n).alias("column"), F.avg((F.col(n) < medians[n]).cast("double")).alias("lower"), F.avg((F.col(n) <= medians[n]).cast("double")).alias("upper")) for n in ("o_custkey", "o_totalprice")]
    ranks = orders.agg(F.array(*below).alias("r")).select(F.inline("r"))
    error = profiles.RANK_ERROR
    middle = (F.col("lower") <= 0.5 + error) & (F.col("upper") >= 0.5 - error)
    joined = found.join(exact, "column").join(ranks, "column", "left")
    return rounded(joined.select("column", "rows", "values", "mean", "low", "high", near.alias("distinct_within_error"), middle.alias("median_within_error")), 4, "mean")
