"""Wide to long and back, pivots with margins, crosstabs, label counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col, first_present, number, present, tall
from newsmill.functions import text as tx
from newsmill.session import cut

ALL = "All"

# The default id columns and measures of the long form.
LONG_IDS = ["record_id", "title", "primary_category", "analysis_year", "document_type", "document_type_mysql"]
LONG_MEASURES = ["popularity", "engagement_score", "estimated_value", "rating_score", "content_length"]
LABEL_COLUMNS = ["category", "genres", "document_type", "source_name", "source_path"]


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], key: str = "metric", value: str = "value") -> DataFrame:
    """One row per id and measure; NULL measures stay."""
    return tall(df, ids, [(v, number(df, v)) for v in values], key, value, "double")


def melt_metrics(df: DataFrame, ids: Sequence[str] | None = None, values: Sequence[str] | None = None) -> DataFrame:
    ids = list(ids or present(df, LONG_IDS))
    values = list(values or present(df, LONG_MEASURES))
    if len(values) < 3:
        raise ValueError(f"at least three measures are needed, found {values}")
    return melt(df, ids, values)


def pivot_values(df: DataFrame, column: str) -> list:
    """The distinct values that become columns, as many as Spark itself allows in a pivot."""
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = [r[0] for r in df.select(col(column)).where(col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values (spark.sql.pivotMaxValues)")
    return sorted(found)


def widen(df: DataFrame, index: str, column: str, value: str, values: Sequence | None = None) -> DataFrame:
    """Long to wide with unique keys; a repeated (index, column) pair is an error."""
    values = list(values) if values is not None else pivot_values(df, column)
    repeated = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("repeated index and column pair")))
    cells = df.groupBy(col(index), col(column)).agg(F.coalesce(repeated.cast(df.schema[value].dataType), F.max(col(value))).alias("_v"))
    return cells.groupBy(col(index)).pivot(column, values).agg(F.first("_v"))


def widen_mean(df: DataFrame, index: Sequence[str], column: str = "metric", value: str = "value", values: Sequence | None = None) -> DataFrame:
    """Long to wide by the mean of each cell; rows with a NULL index vanish."""
    values = list(values) if values is not None else pivot_values(df, column)
    return df.dropna(subset=list(index)).groupBy(*[col(i) for i in index]).pivot(column, values).agg(F.avg(number(df, value)))


def _cube(df: DataFrame, index: str, column: str, cell: Column) -> DataFrame:
    """Cells and margins, all from the raw rows, with ``All`` as the label of a margin."""
    cubed = df.cube(col(index), col(column)).agg(cell.alias("_v"), F.grouping(col(index)).alias("_gi"), F.grouping(col(column)).alias("_gc"))
    return cubed.select(
        F.when(F.col("_gi") == 1, F.lit(ALL)).otherwise(col(index).cast("string")).alias(index),
        F.when(F.col("_gc") == 1, F.lit(ALL)).otherwise(col(column).cast("string")).alias(column),
        "_v",
    )


_AGGREGATES = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}


def pivot_table(
    df: DataFrame, value: str, index: str, column: str, how: str = "mean", fill: float | None = 0, margins: bool = False,
    values: Sequence | None = None,
) -> DataFrame:
    """Aggregated cells; with ``margins`` an ``All`` row and column computed from the rows that
    have a value and both keys, not from the cells."""
    names = [str(v) for v in (values if values is not None else pivot_values(df, column))]
    usable = df.withColumn("_nm_x", number(df, value)).dropna(subset=[index, column])
    if margins:
        usable = usable.where(F.col("_nm_x").isNotNull())
    cell = _AGGREGATES[how](F.col("_nm_x"))
    if margins:
        cells = _cube(usable, index, column, cell)
        names = [*names, ALL]
    else:
        cells = usable.groupBy(col(index).cast("string").alias(index), col(column).cast("string").alias(column)).agg(cell.alias("_v"))
    wide = cells.groupBy(col(index)).pivot(column, names).agg(F.first("_v"))
    return wide.fillna(fill, names) if fill is not None else wide


def crosstab(df: DataFrame, index: str, column: str, normalize: str | None = None, values: Sequence | None = None) -> DataFrame:
    """Counts with ``All`` margins; ``normalize`` divides by the total, the row or the column."""
    names = [*[str(v) for v in (values if values is not None else pivot_values(df, column))], ALL]
    cells = _cube(df.dropna(subset=[index, column]), index, column, F.count(F.lit(1)))
    wide = cells.groupBy(col(index)).pivot(column, names).agg(F.first("_v")).fillna(0, names)
    if normalize is None:
        return wide
    if normalize == "index":
        kept = names[:-1]
        return wide.select(col(index), *[F.try_divide(col(n), col(ALL)).alias(n) for n in kept])
    # The margins are read from the counted table, not counted again.
    wide = cut(wide)
    margin = wide.where(col(index) == ALL)
    if normalize == "columns":
        return wide.where(col(index) != ALL).select(
            col(index), *[F.try_divide(col(n), margin.select(col(n)).scalar()).alias(n) for n in names]
        )
    if normalize != "all":
        raise ValueError(f"unknown normalisation: {normalize}")
    total = margin.select(col(ALL)).scalar()
    return wide.select(col(index), *[F.try_divide(col(n), total).alias(n) for n in names])


def with_labels(df: DataFrame, column: str | None = None, out: str = "category_list") -> DataFrame:
    """Label text parsed to an array, from the first label column that exists."""
    name = column or first_present(df, LABEL_COLUMNS)
    labels = tx.parse_labels(col(name)) if name else F.array().cast("array<string>")
    return df.withColumn(out, labels)


def label_counts(df: DataFrame, column: str | None = None, top: int | None = 15) -> DataFrame:
    """Most frequent labels after the multi-value text is split."""
    exploded = with_labels(df, column, "_nm_labels").select(F.explode("_nm_labels").alias("label"))
    counted = exploded.groupBy("label").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "label")
    return counted.limit(top) if top is not None else counted
