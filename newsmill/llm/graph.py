"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from newsmill.session import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
    return edges.join(least, "b").select("a", F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))))


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The links, written, with their number and a hash of all of them, taken while they are written."""
    seen = Observation()
    counted = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h"))
    stored = cut(counted)
    return stored, tuple(sorted(seen.get.items()))


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links to ``(id, component)``, the smallest id reachable; ids without a link are absent.

    Large star and small star in turn: each round hangs the neighbours of an id under the smallest one. A link
    is kept once, the larger id first; both directions are made where they are needed, without a second read.
    Only minima and joins are used, so that a neighbour list is never gathered, and the rounds grow with
    the logarithm of the longest chain. Every round is written to the shared checkpoint folder.
    """
    state, now = _stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while now != mark:
        mark = now
        state, now = _stored(_small_star(_large_star(state).where("a <> b")).where("a <> b").distinct())
    roots = state.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return state.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots)
