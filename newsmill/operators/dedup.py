"""Keep-first deduplication. Every rule takes the order that says which row is first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.columns import col, first_present
from newsmill.columns import text as as_text
from newsmill.functions import text as tx
from newsmill.operators.ordering import keep_first

# Id and date columns in order of preference.
ID_COLUMNS = ["record_id", "id", "article_id", "document_id", "local_id"]
DATE_COLUMNS = ["published_date", "publishedAt", "release_date"]


def _order(order: Sequence[str]) -> list[Column]:
    return [col(o) for o in order]


def _comparable(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    return as_text(df, name) if isinstance(dtype, (T.MapType, T.VariantType, T.StructType, T.ArrayType)) else col(name)


def row_fingerprint(df: DataFrame, ignore: Sequence[str] = ()) -> list[Column]:
    """Two 64-bit hashes that stand for a whole row but for ``ignore``. Hashes skip NULL, so where the NULLs
    are is hashed as well."""
    compared = [_comparable(df, n) for n in df.columns if n not in set(ignore)]
    gaps = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in compared])
    return [F.xxhash64(gaps, *compared), F.xxhash64(F.lit(1), gaps, *compared)]


def distinct_rows(df: DataFrame, ignore: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """One of each group of rows that are equal in every column, ids included; nested values compare by
    their text, NULL equals NULL.

    Only columns in ``ignore`` (an arrival number, say) are not compared; the row that is first by ``order``
    stays. Sorting goes by two hashes, the whole rows are compared where both meet.
    """
    compared = [_comparable(df, n) for n in df.columns if n not in set(ignore)]
    if not order and not ignore:
        order = df.columns[:1]  # equal rows: any of them is the first
    first = _order(order or ignore)
    keyed = df.withColumns(dict(zip(("_nm_a", "_nm_b"), row_fingerprint(df, ignore))))
    return keep_first(keyed, [F.col("_nm_a"), F.col("_nm_b"), *compared], first).drop("_nm_a", "_nm_b")


def repeats(df: DataFrame, column: str) -> DataFrame:
    """Rows beyond the first per value; all NULLs count as one value."""
    if column not in df.columns:
        return df.sparkSession.sql("SELECT 0L AS duplicate_count")
    c = col(column)
    keys = F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))
    return df.agg(F.coalesce(F.count(F.lit(1)) - keys, F.lit(0)).cast("bigint").alias("duplicate_count"))


def by_id(df: DataFrame, order: Sequence[str], column: str = "record_id") -> DataFrame:
    name = first_present(df, [column, *ID_COLUMNS])
    return df if name is None else keep_first(df, [col(name)], _order(order))


def _where_known(df: DataFrame, keys: Sequence[Column], known: Column, order: Sequence[str], row: str | None) -> DataFrame:
    """Keep-first among the rows where ``known`` holds; all other rows stay.

    With ``row``, a column that is unique per row, those others are groups of one and a single pass is
    enough. Without it they bypass the exchange, and the input is read once more.
    """
    if row is None:
        return keep_first(df.where(known), keys, _order(order)).unionByName(df.where(~known))
    alone = F.when(~known, col(row))
    return keep_first(df, [*[F.when(known, k) for k in keys], alone], [*_order(order), col(row)])


def by_url(df: DataFrame, order: Sequence[str], column: str = "url", row: str | None = None) -> DataFrame:
    """Rows without a URL all stay, whatever their order values."""
    if column not in df.columns:
        return df
    return _where_known(df, [col(column)], ~F.coalesce(tx.is_blank(as_text(df, column)), F.lit(True)), order, row)


def by_title_and_date(df: DataFrame, order: Sequence[str], title: str = "title", date: str | None = None, row: str | None = None) -> DataFrame:
    """Rows without a date all stay, whatever their order values."""
    name = date or first_present(df, DATE_COLUMNS)
    if title not in df.columns or name is None:
        return df
    return _where_known(df, [col(title), col(name)], col(name).isNotNull(), order, row)
