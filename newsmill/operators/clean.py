"""Cleaning steps on whole frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.columns import col, first_present, missing, number, number_or_zero, present, with_id
from newsmill.columns import text as as_text
from newsmill.functions import dates
from newsmill.functions import text as tx
from newsmill.functions.numbers import engagement, worth
from newsmill.operators.aggregates import distinct_counts
from newsmill.operators.ordering import keep_first
from newsmill.operators.quantiles import exact_quantiles
from newsmill.operators.select import without_header_rows

# Which columns each step covers.
BODY_COLUMNS = ["content_text", "overview", "description", "text", "processed_text", "raw_text", "preview_text"]
LABEL_COLUMNS = ["genres", "category", "document_type", "source_name"]
FILLED_COLUMNS = [
    "title", "description", "content_text", "overview", "text", "raw_text", "processed_text",
    "preview_text", "source_name", "category", "document_type", "language",
]
DATE_COLUMNS = ["published_date", "publishedAt", "release_date", "fetched_at", "extraction_timestamp"]
FLOAT_COLUMNS = [
    "rating_score", "sentiment_score", "mentions", "popularity", "vote_average", "vote_count", "wins",
    "losses", "nominations", "awards", "Average Sentiment", "Average Mentions", "Highest Mentions",
]
WHOLE_COLUMNS = [
    "record_id", "id", "page_number", "paragraph_number", "run_number", "published_year",
    "release_year", "year", "content_length", "title_length", "Total Articles", "Total Mentions",
    "Politics Articles", "Business Articles",
]
PROTECTED_COLUMNS = [
    "record_id", "title", "content_text", "overview", "category", "document_type", "language",
    "rating_score", "published_date", "published_year", "source_name", "source_path", "url",
]
LONG_TEXT_COLUMNS = ["content_text", "overview", "description", "text", "processed_text", "raw_text", "preview_text", "url", "tables"]
YEAR_COLUMNS = ["published_year", "published_year_mysql", "published_year_mongo", "release_year", "year"]
YEAR_DATE_COLUMNS = ["published_date", "published_date_mysql", "published_date_mongo", "release_date"]
CATEGORY_COLUMNS = ["category", "genres", "document_type", "document_type_mysql"]
METRIC_COLUMNS = [
    "record_id", "title", "primary_category", "document_type", "source_name", "published_date", "published_year",
    "rating_score", "popularity", "content_length", "title_length", "engagement_score", "estimated_value",
]
DASHBOARD_TEXT = {
    "title": "Untitled", "category": "unknown", "document_type": "unknown", "language": "unknown",
    "source_name": "unknown", "content_text": "", "overview": "",
}
DASHBOARD_NUMBERS = ["record_id", "published_year", "rating_score", "popularity", "content_length", "title_length", "vote_average", "vote_count"]


def clean_titles(df: DataFrame) -> DataFrame:
    return df.withColumn("title", tx.clean_title(as_text(df, "title"))) if "title" in df.columns else df


def clean_languages(df: DataFrame) -> DataFrame:
    """The first language column decides; both columns get the result."""
    name = first_present(df, ["language", "original_language"])
    if name is None:
        return df
    code = tx.clean_language(as_text(df, name))
    return df.withColumns({n: code for n in present(df, ["language", "original_language"])})


def clean_bodies(df: DataFrame) -> DataFrame:
    cleaned = {n: tx.clean_body(as_text(df, n)) for n in present(df, BODY_COLUMNS)}
    if "content_text" in cleaned and "overview" in cleaned:
        cleaned["overview"] = cleaned["content_text"]
    return df.withColumns(cleaned) if cleaned else df


def clean_years(df: DataFrame) -> DataFrame:
    """Year of the first date column that exists, in both year columns."""
    name = first_present(df, ["published_date", "publishedAt", "release_date"])
    if name is None:
        return df
    year = F.year(dates.parsed(df, name))
    return df.withColumns({"published_year": year, "release_year": year})


def clean_labels(df: DataFrame, column: str = "genres") -> DataFrame:
    cleaned = {n: tx.clean_label(as_text(df, n)) for n in present(df, dict.fromkeys([column, *LABEL_COLUMNS[1:]]))}
    if "category" in df.columns and "genres" in df.columns:
        cleaned["genres"] = cleaned["category"]
    return df.withColumns(cleaned) if cleaned else df


def clean_strings(df: DataFrame) -> DataFrame:
    return df.transform(clean_titles).transform(clean_languages).transform(clean_bodies).transform(clean_years).transform(clean_labels)


def drop_incomplete(df: DataFrame, critical: Sequence[str] = ("record_id", "title")) -> DataFrame:
    """Drops rows with a NULL, or a blank text, in a critical column that exists."""
    for n in present(df, critical):
        is_text = isinstance(df.schema[n].dataType, T.StringType)
        df = df.where(tx.strip(col(n)) != "" if is_text else ~missing(df, n))
    return df


def fill_texts(df: DataFrame, names: Sequence[str] | None = None, placeholder: str = tx.NO_TEXT) -> DataFrame:
    filled = {n: F.coalesce(tx.non_blank(as_text(df, n)), F.lit(placeholder)) for n in present(df, names or FILLED_COLUMNS)}
    return df.withColumns(filled) if filled else df


def fill_overview(df: DataFrame) -> DataFrame:
    if "overview" in df.columns:
        return fill_texts(df, ["overview"], tx.NO_OVERVIEW)
    return fill_texts(df, ["content_text"], tx.NO_CONTENT) if "content_text" in df.columns else df


def zero_to_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({n: F.when(number(df, n) != 0, number(df, n)) for n in present(df, names)})


def fill_medians(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """NULL becomes the exact median of its column; a column without values stays. The medians
    are read once (one number per column) and become constants of the plan."""
    names = present(df, names)
    if not names:
        return df
    found = {r["column"]: r["median"] for r in exact_quantiles(df, names, {"median": 0.5}).select("column", "median").collect()}
    filled = {}
    for n in names:
        v = number(df, n)
        filled[n] = v if n not in found else F.coalesce(v.cast("double"), F.lit(float(found[n])))
    return df.withColumns(filled)


def unprotected(df: DataFrame, protected: Sequence[str] | None = None) -> list[str]:
    """The columns that may be dropped."""
    safe = set(PROTECTED_COLUMNS if protected is None else protected)
    return [n for n in df.columns if n not in safe]


def sparse_columns(df: DataFrame, threshold: float = 0.60, protected: Sequence[str] | None = None) -> list[str]:
    """Columns whose share of NULLs is above the threshold; one pass over the frame."""
    names = unprotected(df, protected)
    if not names:
        return []
    shares = df.agg(*[F.avg(missing(df, n).cast("double")).alias(n) for n in names]).first()
    return [n for n in names if (shares[n] or 0.0) > threshold]


def drop_sparse(df: DataFrame, threshold: float = 0.60, protected: Sequence[str] | None = None) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold, protected))


def convert_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({n: dates.parsed(df, n) for n in present(df, DATE_COLUMNS)})


def convert_numbers(df: DataFrame) -> DataFrame:
    """Bad values become NULL; whole numbers are rounded half-even."""
    floats = {n: number(df, n).cast("float") for n in present(df, FLOAT_COLUMNS)}
    wholes = {}
    for n in present(df, WHOLE_COLUMNS):
        v = number(df, n)
        exact = isinstance(df.schema[n].dataType, T.IntegralType)
        wholes[n] = v.cast("bigint") if exact else F.bround(v.cast("double")).try_cast("bigint")
    return df.withColumns({**floats, **wholes})


def convert_types(df: DataFrame) -> DataFrame:
    """Low-cardinality text needs no step: Parquet codes it by dictionary."""
    return df.transform(convert_dates).transform(convert_numbers)


_WHOLE_TYPES = [("tinyint", 8), ("smallint", 16), ("int", 32)]


def type_advice(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Per column the narrowest Spark type for its values; text of less than half distinct values
    is marked as dictionary material. One aggregate over the numbers, one over the texts."""
    fields = [f for f in df.schema.fields if names is None or f.name in names]
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType) and f.name not in LONG_TEXT_COLUMNS]
    # One number per column.
    distinct = {r["column"]: r["nunique"] for r in distinct_counts(df, texts).collect()} if texts else {}
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    rows: list[Column] = []
    for i, f in enumerate(fields):
        current = f.dataType.simpleString()
        c = col(f.name)
        if isinstance(f.dataType, T.IntegralType):
            aggs += [F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}")]
            advice = F.lit("bigint")
            for name, bits in reversed(_WHOLE_TYPES):
                fits = (F.col(f"l{i}") >= -(2 ** (bits - 1))) & (F.col(f"h{i}") < 2 ** (bits - 1))
                advice = F.when(fits, name).otherwise(advice)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            aggs.append(F.max(F.when(c.cast("float").cast("double") != c.cast("double"), 1).otherwise(0)).alias(f"x{i}"))
            advice = F.when(F.col(f"x{i}") == 0, "float").otherwise("double")
        elif f.name in texts:
            advice = F.when(F.lit(distinct[f.name]) < 0.5 * F.col("rows"), "dictionary").otherwise("string")
        else:
            advice = F.lit(current)
        rows.append(F.struct(F.lit(f.name).alias("column"), F.lit(current).alias("dtype"), advice.alias("advice")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def with_primary_category(df: DataFrame, out: str = "primary_category") -> DataFrame:
    name = first_present(df, [out, *CATEGORY_COLUMNS])
    value = as_text(df, name) if name else F.lit(tx.UNKNOWN)
    return df.withColumn(out, tx.plain_label(value, tx.NULL_LABELS[:-1]))


def with_analysis_year(df: DataFrame, out: str = "analysis_year") -> DataFrame:
    """The first year column that exists, else the year of the first date column that exists."""
    name = first_present(df, YEAR_COLUMNS)
    if name is not None:
        return df.withColumn(out, number(df, name).try_cast("int"))
    name = first_present(df, YEAR_DATE_COLUMNS)
    return df.withColumn(out, F.year(dates.parsed(df, name)) if name else F.lit(None).cast("int"))


def with_published_year(df: DataFrame) -> DataFrame:
    """Year of the first date column that has any date, else the year column. Whether a column
    has a date is asked for all of them in one aggregate."""
    names = present(df, DATE_COLUMNS)
    counts = df.agg(*[F.count(dates.parsed(df, n)).alias(n) for n in names]).first() if names else {}
    name = next((n for n in names if counts[n]), None)
    if name is not None:
        year = F.year(dates.parsed(df, name))
    elif "year" in df.columns:
        year = number(df, "year").try_cast("int")
    else:
        return df
    return df.withColumns({"published_year": year, "release_year": year})


def article_metrics(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The typed metrics table: header-like rows, blank titles and rows without an id are gone,
    the first row per id stays, scores are derived from rating, popularity and length."""
    df = with_id(without_header_rows(df, present(df, ["record_id", "title"])))
    category = first_present(df, CATEGORY_COLUMNS[:3])

    def label(name: str | None, default: str) -> Column:
        return F.coalesce(as_text(df, name), F.lit(default)) if name in df.columns else F.lit(default)

    published = dates.parsed(df, "published_date") if "published_date" in df.columns else F.lit(None).cast("timestamp")
    year = number(df, "published_year").try_cast("int") if "published_year" in df.columns else F.year(published)
    length, rating, popularity = (number_or_zero(df, n) for n in ("content_length", "rating_score", "popularity"))
    staged = df.withColumns(
        {
            "record_id": number(df, "record_id").try_cast("bigint"),
            "title": label("title", tx.UNTITLED),
            "primary_category": label(category, tx.UNKNOWN),
            "document_type": label("document_type", tx.UNKNOWN),
            "source_name": label("source_name", tx.UNKNOWN),
            "published_date": published,
            "published_year": year,
            "rating_score": rating,
            "popularity": popularity,
            "content_length": length,
            "title_length": number_or_zero(df, "title_length"),
            "engagement_score": engagement(rating, popularity, length),
        }
    ).withColumn("estimated_value", worth(F.col("engagement_score"), F.col("content_length")))
    valid = without_header_rows(staged, ["title", "primary_category", "document_type", "source_name"], "record_id", "title")
    return keep_first(valid, [F.col("record_id")], [col(o) for o in order]).select(*METRIC_COLUMNS)


def dashboard_rows(df: DataFrame, key: str = "record_id") -> DataFrame:
    """Text defaults, lenient numbers, NULL measures as 0; a missing id becomes a hash of the row."""
    texts = {n: tx.fill(as_text(df, n), d) if n in df.columns else F.lit(d) for n, d in DASHBOARD_TEXT.items()}
    numbers = {n: number(df, n) if n in df.columns else F.lit(None).cast("double") for n in DASHBOARD_NUMBERS}
    row_hash = F.xxhash64(*[as_text(df, n) for n in df.columns])
    numbers["record_id"] = F.coalesce(number(df, key).try_cast("bigint"), row_hash) if key in df.columns else row_hash
    numbers["published_year"] = F.coalesce(numbers["published_year"].try_cast("int"), F.lit(0))
    for n in ("rating_score", "popularity", "content_length"):
        numbers[n] = F.coalesce(numbers[n], F.lit(0))
    numbers["title_length"] = F.coalesce(numbers["title_length"], F.char_length(texts["title"]))
    return df.withColumns({**texts, **numbers})


# The measures of the insight rows, and where their type and title are found.
INSIGHT_MEASURES = ["rating_score", "popularity", "content_length", "title_length", "engagement_score", "estimated_value"]
INSIGHT_TYPES = ["document_type_mysql", "document_type_mongo", "document_type"]
INSIGHT_TITLES = ["title_mysql", "title_mongo", "title"]


def insight_rows(df: DataFrame) -> DataFrame:
    """Category, year, zero-filled measures, document type and title, ready for the questions."""
    df = df.transform(with_primary_category).transform(with_analysis_year)
    kind = first_present(df, INSIGHT_TYPES)
    title = first_present(df, INSIGHT_TITLES)
    kind_text = as_text(df, kind) if kind else F.lit(tx.UNKNOWN)
    title_text = as_text(df, title) if title else F.lit(tx.UNTITLED)
    return df.withColumns(
        {
            **{n: number_or_zero(df, n) for n in INSIGHT_MEASURES},
            "analysis_document_type": tx.plain_label(kind_text, ["", "nan", "none"]),
            "analysis_title": tx.fill(title_text, tx.UNTITLED),
        }
    )
