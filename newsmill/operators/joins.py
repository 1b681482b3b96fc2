"""Joins and set comparisons."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col, number, present, with_id
from newsmill.columns import text as as_text
from newsmill.operators.ordering import keep_first
from newsmill.session import broadcast_if_small

# The descriptive columns carried to a join, and the suffixes of shared names.
METADATA_COLUMNS = [
    "record_id", "title", "description", "url", "source_path", "file_name", "category",
    "document_type", "source_name", "language", "content_text", "published_date", "published_year",
]
SUFFIXES = ("_mysql", "_mongo")

# From how many rows a key counts as hot, and the share of rows looked at to find out.
HOT_ROWS = 1_000_000
HOT_SAMPLE = 0.01


def _keyed(df: DataFrame, on: str) -> DataFrame:
    """The key as a whole number; rows without one cannot match and are dropped."""
    return df.withColumn(on, number(df, on).try_cast("bigint")).where(col(on).isNotNull())


def _suffixed(df: DataFrame, shared: Sequence[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({n: n + suffix for n in shared})


def hot_keys(df: DataFrame, on: str) -> DataFrame:
    """The keys that hold more than about ``HOT_ROWS`` rows, by a sample: one of so many rows at most. No
    result depends on the answer, only the way it is computed."""
    counts = df.select(on).sample(HOT_SAMPLE, seed=42).groupBy(on).count()
    return counts.where(F.col("count") > HOT_ROWS * HOT_SAMPLE).select(on)


def merge(left: DataFrame, right: DataFrame, on: str = "record_id", how: str = "inner", suffixes: tuple[str, str] = SUFFIXES) -> DataFrame:
    """Equi-join; non-key columns in both sides get a suffix.

    Adaptive execution splits a hot key on either side of an inner join, but only on the kept side
    of a left or right join and on neither side of a full one. So hot keys of the sides that it
    could not split go through an inner join of their own; rows of theirs without a partner need
    no join at all.
    """
    if how not in ("inner", "left", "right", "outer"):
        raise ValueError(f"unknown join kind: {how}")
    shared = [n for n in left.columns if n in set(right.columns) and n != on]
    l = _suffixed(_keyed(left, on), shared, suffixes[0])
    r = _suffixed(_keyed(right, on), shared, suffixes[1])
    if how == "inner":
        return l.join(r, on)
    kind = "full_outer" if how == "outer" else how
    sides = ([r] if how in ("left", "outer") else []) + ([l] if how in ("right", "outer") else [])
    hot = broadcast_if_small(reduce(DataFrame.unionAll, [hot_keys(side, on) for side in sides]).distinct())
    if hot.isEmpty():
        return l.join(r, on, kind)

    def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        return df.join(hot, on, "left_semi"), df.join(hot, on, "left_anti")

    (l_hot, l_rest), (r_hot, r_rest) = split(l), split(r)
    parts = [l_rest.join(r_rest, on, kind), l_hot.join(r_hot, on)]
    # Of hot keys, those that the other side has: no more than there are hot keys.
    if how in ("left", "outer"):
        parts.append(l_hot.join(broadcast_if_small(r_hot.select(on).distinct()), on, "left_anti"))
    if how in ("right", "outer"):
        parts.append(r_hot.join(broadcast_if_small(l_hot.select(on).distinct()), on, "left_anti"))
    return same_type_union(parts)


def join_counts(left: DataFrame, right: DataFrame, on: str = "record_id") -> DataFrame:
    """Row counts of the four join kinds from per-key counts; no pair of rows is formed."""

    def per_key(df: DataFrame, out: str) -> DataFrame:
        return _keyed(df, on).groupBy(on).agg(F.count(F.lit(1)).alias(out))

    both = per_key(left, "l").join(per_key(right, "r"), on, "full_outer").fillna(0, ["l", "r"])
    pairs = F.sum(F.col("l") * F.col("r"))
    left_only = F.sum(F.when(F.col("r") == 0, F.col("l")).otherwise(0))
    right_only = F.sum(F.when(F.col("l") == 0, F.col("r")).otherwise(0))
    one = both.agg(pairs.alias("p"), left_only.alias("lo"), right_only.alias("ro")).fillna(0)
    kinds = [
        ("inner", F.col("p")), ("left", F.col("p") + F.col("lo")),
        ("right", F.col("p") + F.col("ro")), ("outer", F.col("p") + F.col("lo") + F.col("ro")),
    ]
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("join_type"), c.alias("row_count")) for k, c in kinds])))


def metadata_side(df: DataFrame, order: Sequence[str], on: str = "record_id") -> DataFrame:
    """The descriptive columns, first row per whole-number id."""
    df = with_id(df, on)
    names = present(df, METADATA_COLUMNS)
    keyed = _keyed(df, on)
    first = keep_first(keyed, [col(on)], [col(o) for o in order])
    return first.select(*[col(n) for n in names])


def with_group_means(df: DataFrame, group: str, values: Sequence[str], prefix: str = "category_avg_") -> DataFrame:
    """Each row with the mean of its group; NULL counts as zero, rows without a group get NULL.

    The means are aggregated once and joined back, so a group is never gathered in one task.
    """
    zeroed = {v: F.coalesce(number(df, v), F.lit(0)) for v in values}
    means = (
        df.where(col(group).isNotNull())
        .groupBy(col(group))
        .agg(*[F.avg(c).alias(prefix + v) for v, c in zeroed.items()])
    )
    return df.withColumns(zeroed).join(broadcast_if_small(means), group, "left")


def large_groups(df: DataFrame, group: str, min_count: int = 5) -> DataFrame:
    """All rows of the groups that have at least ``min_count`` rows."""
    sizes = df.where(col(group).isNotNull()).groupBy(col(group)).count().where(F.col("count") >= min_count)
    return df.join(broadcast_if_small(sizes.select(col(group))), group, "left_semi")


def overlap(a: DataFrame, b: DataFrame, key_a: str = "record_id", key_b: str = "id") -> DataFrame:
    """Shared keys of two results, and their share of the smaller result."""
    left = a.select(as_text(a, key_a).alias("k")).distinct()
    right = b.select(as_text(b, key_b).alias("k")).distinct()
    marked = left.withColumn("in_a", F.lit(1)).join(right.withColumn("in_b", F.lit(1)), "k", "full_outer")
    return marked.agg(
        F.count_if((F.col("in_a") == 1) & (F.col("in_b") == 1)).alias("overlap_count"),
        F.count("in_a").alias("set_a_size"),
        F.count("in_b").alias("set_b_size"),
    ).select(
        "overlap_count",
        F.coalesce(F.try_divide("overlap_count", F.least("set_a_size", "set_b_size")), F.lit(0.0)).alias("overlap_ratio"),
        "set_a_size",
        "set_b_size",
    )


def same_type_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Stacks frames by column name; a column that a frame lacks is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def last_per_key(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the last in ``order``, and without one (or on a tie) that with the largest hash of
    the whole row, so that the choice does not depend on how the rows are spread."""
    spread = F.xxhash64(*[as_text(df, n) for n in df.columns])
    return keep_first(df, [col(key)], [*[col(o).desc() for o in order], spread.desc()])


def upsert(old: DataFrame, new: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """``new`` replaces whole rows of ``old`` by key; of a repeated key :func:`last_per_key` counts."""
    latest = last_per_key(new, key, order)
    kept = old.join(latest.select(key).distinct(), key, "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)


def merge_fields(old: DataFrame, new: DataFrame, key: str, given: str | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Upsert by field: the fields that ``new`` gives replace, the others stay; of a repeated key
    :func:`last_per_key` counts.

    ``given`` names an array column of ``new`` with the field names set in each row, so that an
    explicit NULL also replaces; without it every column of ``new`` counts as given.
    """
    new = last_per_key(new, key, order)
    fields = [n for n in new.columns if n not in (key, given)]
    changes = new.select(
        col(key),
        F.lit(True).alias("_nm_hit"),
        (col(given) if given else F.array(*[F.lit(f) for f in fields])).alias("_nm_given"),
        *[col(f).alias(f"_nm_new_{f}") for f in fields],
    )
    both = old.join(changes, key, "full_outer")
    out = [col(key)]
    for name in dict.fromkeys([*[c for c in old.columns if c != key], *fields]):
        stored = col(name) if name in old.columns else F.lit(None)
        if name in fields:
            replaced = F.coalesce(F.col("_nm_hit"), F.lit(False)) & F.array_contains("_nm_given", name)
            stored = F.when(replaced, col(f"_nm_new_{name}")).otherwise(stored)
        out.append(stored.alias(name))
    return both.select(*out)


def only_new(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of ``incoming`` whose key is not stored yet, one per key."""
    return last_per_key(incoming, key).join(stored.select(key).distinct(), key, "left_anti")
