"""Grouped summaries, profiles and chart data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.columns import col, fingerprint, first_present, number, number_or_zero, numeric_columns, present, tall, text_columns
from newsmill.columns import text as as_text
from newsmill.functions import text as tx
from newsmill.functions.numbers import clip, half_even
from newsmill.operators.quantiles import exact_quantiles, medians
from newsmill.session import broadcast_if_small, cut

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def with_zeroed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Absent measures and NULL values count as zero."""
    return df.withColumns({n: number_or_zero(df, n) for n in names})


def _with_medians(summary: DataFrame, df: DataFrame, group: str, renamed: dict[str, str]) -> DataFrame:
    """Joins exact medians to a grouped summary: both sides have one row per group."""
    found = medians(df, list(renamed), [group]).withColumnsRenamed({f"median_{v}": out for v, out in renamed.items()})
    return summary.join(found, group)


def category_summary(df: DataFrame, group: str = "primary_category", key: str = "record_id") -> DataFrame:
    """Twelve measures per category, richest first."""
    z = with_zeroed(df, ["rating_score", "popularity", "content_length", "engagement_score", "estimated_value"])
    z = z.where(col(group).isNotNull())
    summary = z.groupBy(col(group)).agg(
        F.count(col(key)).alias("article_count"),
        F.avg("rating_score").alias("avg_rating_score"),
        F.sum("estimated_value").alias("total_estimated_value"),
        F.avg("estimated_value").alias("avg_estimated_value"),
        F.max("estimated_value").alias("max_estimated_value"),
        F.sum("engagement_score").alias("total_engagement_score"),
        F.avg("engagement_score").alias("avg_engagement_score"),
        F.avg("popularity").alias("avg_popularity"),
        F.sum("content_length").alias("total_content_length"),
    )
    names = {"rating_score": "median_rating_score", "estimated_value": "median_estimated_value", "content_length": "median_content_length"}
    return _with_medians(summary, z, group, names).orderBy(F.desc("total_estimated_value"), col(group))


def document_type_summary(df: DataFrame, group: str = "document_type", key: str = "record_id") -> DataFrame:
    name = first_present(df, [group, "document_type"])
    z = df if name else df.withColumn("document_type", F.lit(tx.UNKNOWN))
    name = name or "document_type"
    z = with_zeroed(z, ["rating_score", "estimated_value", "engagement_score", "content_length"]).where(col(name).isNotNull())
    summary = z.groupBy(col(name)).agg(
        F.count(col(key)).alias("article_count"),
        F.avg("rating_score").alias("avg_rating_score"),
        F.sum("estimated_value").alias("total_estimated_value"),
        F.avg("estimated_value").alias("avg_estimated_value"),
        F.sum("engagement_score").alias("total_engagement_score"),
        F.avg("content_length").alias("avg_content_length"),
    )
    return _with_medians(summary, z, name, {"rating_score": "median_rating_score"}).orderBy(F.desc("article_count"), col(name))


def yearly_summary(
    df: DataFrame, year: str = "analysis_year", first: int | None = None, last: int | None = None, key: str = "record_id"
) -> DataFrame:
    """Seven measures per year that has rows, in order; the bounds are inclusive."""
    z = with_zeroed(df, ["rating_score", "estimated_value", "engagement_score", "content_length"])
    z = z.withColumn(year, number(df, year).try_cast("int")).where(col(year).isNotNull())
    if first is not None:
        z = z.where(col(year) >= first)
    if last is not None:
        z = z.where(col(year) <= last)
    summary = z.groupBy(col(year)).agg(
        F.count(col(key)).alias("article_count"),
        F.avg("rating_score").alias("avg_rating_score"),
        F.sum("estimated_value").alias("total_estimated_value"),
        F.avg("estimated_value").alias("avg_estimated_value"),
        F.sum("engagement_score").alias("total_engagement_score"),
        F.sum("content_length").alias("total_content_length"),
    )
    return _with_medians(summary, z, year, {"rating_score": "median_rating_score"}).orderBy(col(year))


def _any_text(df: DataFrame, names: Sequence[str]) -> Column:
    found = [F.coalesce(as_text(df, n), F.lit("")) != "" for n in present(df, names)]
    out = F.lit(False)
    for f in found:
        out = out | f
    return out


# A record is counted by category if it has any of these.
GROUPED_BY_ANY_OF = ["category", "document_type", "source_name", "source", "source_path", "name"]


def _first_value(df: DataFrame, names: Sequence[str]) -> Column:
    return F.coalesce(*[as_text(df, n) for n in present(df, names)], F.lit(tx.UNKNOWN))


def store_category_groups(df: DataFrame, order: str) -> DataFrame:
    """Records, titles, texts and document types per category; the sample source is that of the
    first record by ``order``, a column of unique numbers. Records without any of the six describing
    fields are left out.

    Only the number of the first record is aggregated: a text in the aggregate would make Spark
    sort the whole input. Its source is looked up afterwards.
    """
    given = [col(n).isNotNull() for n in present(df, GROUPED_BY_ANY_OF)]
    counted = df.where(reduce(or_, given)) if given else df.limit(0)
    staged = counted.select(
        _first_value(df, ["category", "document_type"]).alias("category"),
        _first_value(df, ["document_type"]).alias("_type"),
        _first_value(df, ["source_name", "source", "source_path"]).alias("_source"),
        _any_text(df, ["title", "name"]).alias("_titled"),
        _any_text(df, ["text", "raw_text", "processed_text", "preview_text"]).alias("_texted"),
        col(order).alias("_order"),
    )
    groups = broadcast_if_small(
        staged.groupBy("category").agg(
            F.count(F.lit(1)).alias("record_count"),
            F.count_if("_titled").alias("titles_available"),
            F.count_if("_texted").alias("text_records_available"),
            F.count_distinct("_type").alias("unique_document_type_count"),
            F.min("_order").alias("_order"),
        )
    )
    sources = staged.select("_order", F.col("_source").alias("sample_source"))
    return sources.join(groups, "_order").drop("_order").orderBy(F.desc("record_count"), "category")


def store_type_groups(df: DataFrame) -> DataFrame:
    """Here an empty title counts as a title; only NULL does not."""
    title = F.count("title") if "title" in df.columns else F.lit(0).cast("bigint")
    return (
        df.groupBy("document_type")
        .agg(F.count(F.lit(1)).alias("record_count"), title.alias("titles_available"))
        .orderBy(F.desc("record_count"), "document_type")
    )


def store_source_groups(df: DataFrame) -> DataFrame:
    source = _first_value(df, ["source_name", "source", "source_path"]).alias("source_name")
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("record_count")).orderBy(F.desc("record_count"), "source_name")


def global_mean(df: DataFrame, value: str = "rating_score") -> DataFrame:
    v = number(df, value)
    return df.agg(
        F.coalesce(F.avg(v), F.lit(0.0)).alias("global_mean"), F.count(F.lit(1)).alias("total_rows"), F.count(v).alias("rating_count")
    )


def mean_by_group(df: DataFrame, group: str = "language", value: str = "rating_score") -> DataFrame:
    """Mean and count of the rows that have both a group and a value."""
    if group not in df.columns:
        df = df.withColumn(group, F.lit(tx.UNKNOWN))
    v = number(df, value)
    return (
        df.where(col(group).isNotNull() & v.isNotNull())
        .groupBy(col(group))
        .agg(F.avg(v).alias(f"mean_{value}"), F.count(v).alias("record_count"))
        .orderBy(F.desc("record_count"), col(group))
    )


def kpi_row(df: DataFrame) -> DataFrame:
    """Counts and rounded means of a frame with the dashboard columns.

    The rows are summed per pair of labels before the labels are counted: two distinct counts over
    the raw rows would send every row through the shuffle twice.
    """
    means = {"rating_score": "avg_rating", "popularity": "avg_popularity", "content_length": "avg_content_length"}
    sums = []
    for n in means:
        sums += [F.sum(number(df, n).cast("double")).alias(f"s_{n}"), F.count(number(df, n)).alias(f"n_{n}")]
    pairs = df.groupBy("category", "document_type").agg(F.count(F.lit(1)).alias("n"), *sums)
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.count_distinct("category").alias("category_count"),
        F.count_distinct("document_type").alias("document_type_count"),
        *[F.coalesce(half_even(F.try_divide(F.sum(f"s_{n}"), F.sum(f"n_{n}"))), F.lit(0.0)).alias(out) for n, out in means.items()],
    )


# First characters of a value that are counted along with its fingerprint.
HEAD = 32


def _told_apart(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``column``, ``value``, and its fingerprint as ``a``, ``b`` and ``none`` (whether it is NULL)."""
    rows = tall(df, [], [(n, as_text(df, n)) for n in names], "column", "value", "string")
    f = fingerprint(F.col("value"))
    return rows.select("column", "value", f["a"].alias("a"), f["b"].alias("b"), F.col("value").isNull().alias("none"))


_VALUE = ["column", "a", "b", "none"]


def _top_values(rows: DataFrame, counts: DataFrame, top: int) -> DataFrame:
    """``column``, ``value``, ``count`` and ``rank`` of the ``top`` values: the counts say which fingerprints may be
    among them, then only the values of these are taken from the rows."""
    level = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("none"), F.asc("head"))
    leading = counts.withColumn("rank", F.rank().over(level)).where(F.col("rank") <= top).drop("rank", "head")
    found = rows.join(broadcast_if_small(leading), _VALUE).groupBy(*_VALUE, "count").agg(F.min("value").alias("value"))
    best = Window.partitionBy("column").orderBy(F.desc("count"), F.asc_nulls_last("value"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("column", "value", "count", "rank")


def _value_groups(rows: DataFrame) -> DataFrame:
    """One row per column and fingerprint with its count and the first characters of the value, which settle most ties."""
    return rows.groupBy(*_VALUE).agg(F.count(F.lit(1)).alias("count"), F.min(F.left("value", F.lit(HEAD))).alias("head"))


def value_counts(df: DataFrame, names: Sequence[str], top: int = 15) -> DataFrame:
    """The ``top`` values of each column with its distinct count. NULL is a value in the counts but not in the
    distinct count. Values are counted by fingerprint, so that long texts are not shuffled; only those that may be
    among the first are taken from the rows afterwards."""
    rows = _told_apart(df, names)
    counts = cut(_value_groups(rows))
    distinct = counts.groupBy("column").agg(F.count_if(~F.col("none")).alias("nunique"))
    # One row per named column.
    return _top_values(rows, counts, top).join(F.broadcast(distinct), "column").select("column", "value", "count", "rank", "nunique")


def distinct_counts(df: DataFrame, names: Sequence[str] | None = None, relative_error: float | None = None) -> DataFrame:
    """Distinct non-NULL values and type per column. With ``relative_error`` the counts are
    estimates from one pass without a shuffle of the values."""
    names = list(names or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if relative_error is not None:
        one = df.agg(*[F.approx_count_distinct(col(n), relative_error).alias(n) for n in names])
        found = tall(one, [], [(n, col(n)) for n in names], "column", "nunique", "bigint")
    else:
        values = tall(df, [], [(n, as_text(df, n)) for n in names], "column", "value", "string")
        values = values.where("value IS NOT NULL").select("column", fingerprint(F.col("value")).alias("value"))
        some = values.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("nunique"))
        every = df.sparkSession.createDataFrame([(n,) for n in names], "column string")
        found = every.join(some, "column", "left").fillna(0, ["nunique"])
    dtype = F.create_map(*[F.lit(x) for n in names for x in (n, types[n])])[F.col("column")]
    return found.select("column", "nunique", dtype.alias("dtype")).orderBy(F.desc("nunique"), "column")


def describe_numbers(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row per column."""
    names = list(names or numeric_columns(df))
    moments = []
    for i, n in enumerate(names):
        c = number(df, n).cast("double")
        moments += [F.count(c).alias(f"n{i}"), F.avg(c).alias(f"a{i}"), F.stddev_samp(c).alias(f"s{i}"), F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}")]
    one = df.agg(*moments)
    rows = [
        F.struct(
            F.lit(n).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("std"),
            F.col(f"l{i}").alias("min"), F.col(f"h{i}").alias("max"),
        )
        for i, n in enumerate(names)
    ]
    quartiles = exact_quantiles(df, names, QUARTILES).select("column", "q1", "median", "q3")
    moments = one.select(F.inline(F.array(*rows)))
    return moments.join(quartiles, "column", "left").select("column", "count", "mean", "std", "min", "q1", "median", "q3", "max")


def describe_all(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Numeric columns as in :func:`describe_numbers`; text columns with distinct count, most
    frequent value (smallest on a tie) and its count."""
    names = list(names or [*numeric_columns(df), *text_columns(df)])
    texts = [n for n in names if n in text_columns(df)]
    numbers = [n for n in names if n in numeric_columns(df)]
    parts = []
    if numbers:
        parts.append(describe_numbers(df, numbers))
    if texts:
        rows = _told_apart(df, texts)
        counts = cut(_value_groups(rows))
        known = counts.where("NOT none")
        sizes = counts.groupBy("column").agg(F.coalesce(F.sum(F.when(~F.col("none"), F.col("count"))), F.lit(0)).alias("count"), F.count_if(~F.col("none")).alias("unique"))
        first = _top_values(rows, known, 1).select("column", F.col("value").alias("top"), F.col("count").alias("freq"))
        parts.append(sizes.join(first, "column", "left").select("column", "count", "unique", "top", "freq"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def shape(df: DataFrame) -> DataFrame:
    width = len(df.columns)
    names = ", ".join(df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(width).cast("bigint").alias("columns"), (F.col("rows") * width).alias("cells"), F.lit(names).alias("column_names")
    )


def weighted_ratings(df: DataFrame, rating: str, mentions: str) -> DataFrame:
    """Row measures of a rating and a mention count."""
    r, m = number(df, rating), number(df, mentions)
    return df.withColumns(
        {
            "normalised": r * 10,
            "weighted": half_even(r * F.log1p(m)),
            "high_rated": r > 7.5,
            "high_impact": (r > 7.0) & (m > 20),
        }
    )


def rating_stats(df: DataFrame, rating: str, mentions: str) -> DataFrame:
    """The deviation is that of the whole population."""
    r, m = number(df, rating), number(df, mentions)
    return df.agg(
        F.avg(r).alias("mean"), F.stddev_pop(r).alias("std"), F.max(r).alias("max"),
        F.min(m).cast("bigint").alias("min_mentions"), F.sum(m).cast("bigint").alias("total_mentions"),
    )


def column_reductions(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean and population deviation down each column."""
    pairs = []
    for i, n in enumerate(names):
        pairs += [F.avg(number(df, n)).alias(f"a{i}"), F.stddev_pop(number(df, n)).alias(f"s{i}")]
    rows = [F.struct(F.lit(n).alias("column"), F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("std")) for i, n in enumerate(names)]
    return df.agg(*pairs).select(F.inline(F.array(*rows)))


def row_means(df: DataFrame, names: Sequence[str], out: str = "row_mean") -> DataFrame:
    total = number(df, names[0])
    for n in names[1:]:
        total = total + number(df, n)
    return df.withColumn(out, total / len(names))


def correlations(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pearson coefficient of every column pair over the rows that have both values; one pass.
    Columns with fewer than two values give no row."""
    pairs = [(a, a) for a in names] + list(combinations(names, 2))
    doubles = {n: number(df, n).cast("double") for n in names}
    exprs = []
    for i, (a, b) in enumerate(pairs):
        both = doubles[a].isNotNull() & doubles[b].isNotNull()
        exprs.append(F.corr(F.when(both, doubles[a]), F.when(both, doubles[b])).alias(f"r{i}"))
    exprs += [F.count(doubles[n]).alias(f"c_{i}") for i, n in enumerate(names)]
    enough = {n: F.col(f"c_{i}") > 1 for i, n in enumerate(names)}
    rows = []
    for i, (a, b) in enumerate(pairs):
        for x, y in dict.fromkeys([(a, b), (b, a)]):
            rows.append(F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"r{i}").alias("corr"), (enough[a] & enough[b]).alias("ok")))
    return df.agg(*exprs).select(F.inline(F.array(*rows))).where("ok").drop("ok")


def histogram(df: DataFrame, value: str, bins: int = 30, groups: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over the whole range, the last one closed; bins without rows are absent."""
    v = number(df, value).cast("double")
    valued = df.select(*[col(g) for g in groups], v.alias("_v")).where("_v IS NOT NULL")
    limits = valued.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    lo, hi = limits.select("lo").scalar(), limits.select("hi").scalar()
    step = (hi - lo) / bins
    index = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((F.col("_v") - lo) / step), F.lit(bins - 1))).cast("int")
    counted = valued.withColumn("bin", index).groupBy(*[col(g) for g in groups], "bin").agg(F.count(F.lit(1)).alias("count"))
    return counted.select(
        *[col(g) for g in groups], "bin", (lo + F.col("bin") * step).alias("bin_start"), (lo + (F.col("bin") + 1) * step).alias("bin_end"), "count"
    )


def top_values(df: DataFrame, column: str, top: int) -> DataFrame:
    """The ``top`` most frequent labels; NULL and blank count as unknown."""
    label = tx.fill(as_text(df, column), tx.UNKNOWN).alias(column)
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column).limit(top)


def in_top_groups(df: DataFrame, column: str, top: int) -> DataFrame:
    """Rows of the ``top`` most frequent labels, the label tidied. The labels, at most ``top`` of
    them, are read once and become constants of the plan."""
    labels = [r[0] for r in top_values(df, column, top).select(column).collect()]
    tidy = df.withColumn(column, tx.fill(as_text(df, column), tx.UNKNOWN))
    return tidy.where(col(column).isin(labels))


def box_numbers(df: DataFrame, value: str, group: str, top: int = 8) -> DataFrame:
    """Quartiles, whiskers (the furthest values within 1.5 IQR) and outlier counts for the largest
    groups, ordered by median."""
    rows = in_top_groups(df, group, top).select(col(group), number(df, value).cast("double").alias("_v")).where("_v IS NOT NULL")
    box = exact_quantiles(rows, ["_v"], QUARTILES, [group]).drop("column")
    iqr = F.col("q3") - F.col("q1")
    # At most ``top`` rows, used twice.
    box = cut(box.withColumns({"low_fence": F.col("q1") - 1.5 * iqr, "high_fence": F.col("q3") + 1.5 * iqr}))
    joined = rows.join(F.broadcast(box), group)
    inside = F.col("_v").between(F.col("low_fence"), F.col("high_fence"))
    spread = joined.groupBy(group).agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
    return box.join(spread, group).select(group, "n", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers").orderBy("median", group)


def bar_data(df: DataFrame, group: str, means: dict[str, str], top: int = 10, key: str = "record_id") -> DataFrame:
    """Largest groups with their means; ``means`` maps a measure to its output name."""
    label = tx.fill(as_text(df, group), tx.UNKNOWN).alias(group)
    aggs = [F.avg(number(df, n)).alias(out) for n, out in means.items()]
    return df.groupBy(label).agg(F.count(col(key)).alias("record_count"), *aggs).orderBy(F.desc("record_count"), group).limit(top)


def yearly_chart(df: DataFrame, year: str, means: dict[str, str], key: str = "record_id") -> DataFrame:
    aggs = [F.avg(number(df, n)).alias(out) for n, out in means.items()]
    known = df.withColumn(year, number(df, year).try_cast("int")).where(col(year) > 0)
    return known.groupBy(col(year)).agg(F.count(col(key)).alias("record_count"), *aggs).orderBy(col(year))


def scatter_data(df: DataFrame, x: str, y: str, size: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Points that have every plotted value; the size is clipped to 0.2–10."""
    plotted = [n for n in (x, y, size) if n]
    points = df.dropna(subset=plotted).select(*[col(k) for k in keep], *[number(df, n).alias(n) for n in plotted])
    return points.withColumn("marker_size", clip(col(size).cast("double"), 0.2, 10.0)) if size else points


def top_of(df: DataFrame, by: str, group: str, top: int = 10) -> DataFrame:
    """The best rows of a summary."""
    return df.orderBy(F.desc(by), col(group)).limit(top)


def scaled(df: DataFrame, value: str, out: str = "scaled") -> DataFrame:
    """Min-max scaling to 0–1; a constant column scales to 0."""
    v = number(df, value).cast("double")
    limits = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    lo, hi = limits.select("lo").scalar(), limits.select("hi").scalar()
    return df.withColumn(out, F.when(hi == lo, F.lit(0.0)).otherwise((v - lo) / (hi - lo)))
