"""Projections, filters and facets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.columns import col, first_present, is_floating, number, present, stored_number
from newsmill.columns import text as as_text
from newsmill.functions import text as tx

# The column sets and value lists used when the caller names none.
RATING_COLUMNS = ["record_id", "title", "document_type", "category", "rating_score", "mentions", "popularity", "language"]
DEFAULT_VALUES = {
    "language": ["en", "unknown"],
    "category": ["news_api", "Politics", "Business", "Technology", "Sports"],
    "document_type": ["news_api", "json", "pdf", "word", "excel"],
}
TEXT_COLUMNS = ["content_text", "overview", "description", "text", "processed_text", "raw_text", "preview_text"]
# Stands for the main text of a table.
MAIN_TEXT = "*"
TERM_ROWS = ["record_id", "title", MAIN_TEXT, "category", "document_type", "source_name"]
SHORT_ROWS = ["record_id", "title", MAIN_TEXT, "category", "document_type"]
SEARCHABLE = ["title", "content_text", "overview", "category", "document_type"]
DEFAULT_YEARS = (2026, 2026)


def _not_nan(df: DataFrame, name: str) -> Column:
    return ~F.isnan(col(name)) if is_floating(df, name) else F.lit(True)


def nothing(df: DataFrame) -> DataFrame:
    return df.where(F.lit(False))


def select_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[col(n) for n in present(df, names)])


def at_least(df: DataFrame, low: float = 7.0, column: str = "rating_score", keep: Sequence[str] | None = None) -> DataFrame:
    """Rows whose number reaches ``low``; text that is no number fails."""
    name = first_present(df, [column, "vote_average"])
    if name is None:
        return nothing(df)
    hit = df.where((stored_number(df, name) >= low) & _not_nan(df, name))
    return select_present(hit, keep or RATING_COLUMNS)


def between(df: DataFrame, low: float = 2.0, high: float = 8.0, column: str = "rating_score") -> DataFrame:
    """Both ends belong to the range."""
    fallback = ["vote_average"] if column == "rating_score" else []
    name = first_present(df, [column, *fallback, "content_length"])
    return nothing(df) if name is None else df.where(stored_number(df, name).between(low, high))


def rated_and_mentioned(
    df: DataFrame, min_rating: float = 5.0, min_mentions: float = 1, min_popularity: float = 10.0,
    rating: str | None = None, mentions: str | None = None, popularity: str | None = None,
) -> DataFrame:
    """Rating above, mentions at least, popularity above; NULL mentions and popularity count as 0."""
    names = [
        rating or first_present(df, ["rating_score", "vote_average"]),
        mentions or first_present(df, ["mentions", "vote_count"]),
        popularity or first_present(df, ["popularity", "content_length"]),
    ]
    if any(n is None or n not in df.columns for n in names):
        return nothing(df)
    r, m, p = stored_number(df, names[0]), number(df, names[1]), number(df, names[2])
    zero = F.lit(0)
    return df.where((r > min_rating) & _not_nan(df, names[0]) & (F.coalesce(m, zero) >= min_mentions) & (F.coalesce(p, zero) > min_popularity))


def in_values(df: DataFrame, values: Sequence[Any] | None = None, column: str = "language", exclude: bool = False) -> DataFrame:
    """Compared as text. NULL is never in the list, so the excluding form keeps it."""
    fallback = ["original_language"] if column == "language" else []
    name = first_present(df, [column, *fallback, "category", "document_type"])
    if name is None:
        return nothing(df)
    if values is None:
        values = DEFAULT_VALUES.get(name)
    if values is None:
        # The first five distinct values, taken in value order since rows have none.
        top = df.select(as_text(df, name).alias("v")).where("v IS NOT NULL").distinct().orderBy("v").limit(5)
        values = [r[0] for r in top.collect()]
    hit = F.coalesce(as_text(df, name), F.lit("nan")).isin([str(v) for v in values])
    return df.where(~hit if exclude else hit)


def main_text(df: DataFrame) -> str | None:
    return first_present(df, TEXT_COLUMNS)


def starts_with(df: DataFrame, prefix: str = "The", column: str = "title") -> DataFrame:
    return df.where(tx.starts_with_word(as_text(df, column), prefix)) if column in df.columns else nothing(df)


def with_terms(df: DataFrame, terms: Sequence[str], column: str | None = None) -> DataFrame:
    """Rows whose main text holds one of the terms as a whole word."""
    name = column or main_text(df)
    if name is None:
        return nothing(df)
    hit = df.where(tx.has_any_word(as_text(df, name), list(terms)))
    return select_present(hit, [name if n == MAIN_TEXT else n for n in TERM_ROWS])


def topic_rows(df: DataFrame) -> DataFrame:
    return with_terms(df, tx.TOPIC_TERMS)


def crime_rows(df: DataFrame) -> DataFrame:
    return with_terms(df, tx.CRIME_TERMS)


def term_counts(df: DataFrame, column: str | None = None) -> DataFrame:
    """Both vocabularies counted in one pass over the text."""
    name = column or main_text(df)
    if name is None:
        return df.sparkSession.sql("SELECT 0L AS topic_count, 0L AS crime_count")
    body = as_text(df, name)
    return df.agg(
        F.count_if(tx.has_any_word(body, tx.TOPIC_TERMS)).alias("topic_count"),
        F.count_if(tx.has_any_word(body, tx.CRIME_TERMS)).alias("crime_count"),
    )


def short_texts(df: DataFrame, limit: int = 40, column: str | None = None) -> DataFrame:
    name = column or main_text(df)
    if name is None:
        return nothing(df)
    return select_present(df.where(tx.is_short(as_text(df, name), limit)), [name if n == MAIN_TEXT else n for n in SHORT_ROWS])


def flag_short(df: DataFrame, column: str = "content_text", limit: int = 40) -> DataFrame:
    name = first_present(df, [column, "overview"])
    flag = F.lit(False) if name is None else tx.is_short(as_text(df, name), limit)
    return df.withColumn("is_short_content", flag)


def faceted(
    df: DataFrame, categories: Sequence[str] = (), document_types: Sequence[str] = (),
    years: tuple[int, int] | None = None, search: str | None = None,
) -> DataFrame:
    """Optional facets on a frame with the dashboard columns. Year 0 means unknown and always
    passes; the search is a literal lower-case substring over five fields."""
    out = df
    if categories:
        out = out.where(col("category").isin(list(categories)))
    if document_types:
        out = out.where(col("document_type").isin(list(document_types)))
    if years:
        year = col("published_year")
        out = out.where(year.between(int(years[0]), int(years[1])) | (year == 0))
    needle = (search or "").strip().lower()
    if needle:
        fields = [F.coalesce(as_text(out, n), F.lit("")) for n in SEARCHABLE]
        out = out.where(F.contains(F.lower(F.concat_ws(" ", *fields)), F.lit(needle)))
    return out


def facet_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values; blank becomes unknown, NULL is left out."""
    value = tx.fill(as_text(df, column), tx.UNKNOWN).alias(column)
    return df.where(col(column).isNotNull()).select(value).distinct().orderBy(column)


def year_range(df: DataFrame, column: str = "published_year") -> DataFrame:
    """First and last known year in one row."""
    known = F.when(number(df, column) > 0, number(df, column))
    return df.agg(
        F.coalesce(F.min(known), F.lit(DEFAULT_YEARS[0])).try_cast("int").alias("first_year"),
        F.coalesce(F.max(known), F.lit(DEFAULT_YEARS[1])).try_cast("int").alias("last_year"),
    )


_COMPARE = {
    "$eq": lambda c, v: c == F.lit(v),
    "$ne": lambda c, v: c != F.lit(v),
    "$gt": lambda c, v: c > F.lit(v),
    "$gte": lambda c, v: c >= F.lit(v),
    "$lt": lambda c, v: c < F.lit(v),
    "$lte": lambda c, v: c <= F.lit(v),
    "$in": lambda c, v: c.isin(list(v)),
    "$nin": lambda c, v: ~c.isin(list(v)),
}


def predicate(where: Mapping[str, Any]) -> Column:
    """A metadata filter such as ``{"$and": [{"year": {"$gte": 2026}}, {"category": "sports"}]}``."""
    clauses: list[Column] = []
    for key, value in where.items():
        if key in ("$and", "$or"):
            joiner = (lambda a, b: a & b) if key == "$and" else (lambda a, b: a | b)
            clauses.append(reduce(joiner, [predicate(v) for v in value]))
        elif isinstance(value, Mapping):
            clauses += [_COMPARE[op](col(key), v) for op, v in value.items()]
        else:
            clauses.append(col(key) == F.lit(value))
    if not clauses:
        raise ValueError("empty filter")
    return reduce(lambda a, b: a & b, clauses)


def matching(df: DataFrame, where: Mapping[str, Any] | None) -> DataFrame:
    return df.where(predicate(where)) if where else df


def without_header_rows(df: DataFrame, names: Sequence[str], id_column: str | None = None, title_column: str | None = None) -> DataFrame:
    """Drops rows whose cell repeats its own column name, rows without an id and blank titles."""
    out = df
    for name in present(df, names):
        out = out.where(~F.coalesce(F.lower(as_text(df, name)) == name.lower(), F.lit(False)))
    if id_column:
        out = out.where(number(out, id_column).isNotNull())
    if title_column:
        out = out.where(~tx.is_blank(as_text(out, title_column)))
    return out
