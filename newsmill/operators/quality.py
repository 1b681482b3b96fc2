"""Quality reports. Every report is one aggregate over the input, turned on its side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col, fingerprint, first_present, missing, number, numeric_columns, present, tall
from newsmill.columns import text as as_text
from newsmill.functions import dates
from newsmill.functions import text as tx
from newsmill.functions.numbers import half_even, severity, share
from newsmill.operators.quantiles import exact_quantiles, long_values
from newsmill.session import cut

# The checked columns, ranges and issue texts.
ZERO_COLUMNS = ["mentions", "sentiment_score", "rating_score", "content_length", "title_length", "popularity", "vote_average", "vote_count"]
TEN_POINT_COLUMNS = ["rating_score", "vote_average", "rating", "relevance_score", "quality_score"]
ID_CHECKED = ["record_id", "id", "article_id", "document_id", "local_id", "url", "source_path"]
CONTENT_COLUMNS = ["content_text", "overview", "description", "text", "processed_text", "raw_text"]
DATE_CHECKED = ["published_date", "publishedAt", "release_date", "fetched_at", "extraction_timestamp"]
YEAR_CHECKED = ["published_year", "release_year", "year"]
REQUIRED_COLUMNS = ["title", "content_text", "category", "document_type", "rating_score"]
YEARS = (1900, 2100)
SCORES = (0, 10)
ISSUE_MISSING = "Missing values"
ISSUE_ZERO = "Zero values may represent missing or incomplete analytics data"
ISSUE_SCORE = "Score outside valid 0-10 range"
ISSUE_SENTIMENT = "Sentiment score outside valid 0-1 range"
ISSUE_DUPLICATE = "Duplicate identifiers / repeated records"
ISSUE_TITLE_COLUMN = "Missing title column"
ISSUE_TITLE_MISSING = "Missing titles"
ISSUE_TITLE_EMPTY = "Empty titles"
ISSUE_TITLE_FORM = "Invalid title format"
ISSUE_TITLE_SHORT = "Unusually short titles"
ISSUE_CONTENT_COLUMN = "Missing content text column"
ISSUE_CONTENT_EMPTY = "Empty content text"
ISSUE_CONTENT_SHORT = "Unusually short content text"
ISSUE_DATE = "Invalid date format"
ISSUE_YEAR = "Year outside expected news/document range"
ISSUE_OUTLIER = "IQR outliers detected"
ISSUE_DATE_TEXT = "Invalid date format; expected YYYY-MM-DD"
ISSUE_LANGUAGE_TEXT = "Invalid language code"

# One check: column, issue, row test, severity from its percentage.
Check = tuple[str, str, Column, object]


def _fixed(label: str):
    return lambda pct: F.lit(label)


def _run(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Counts the rows each check hits and keeps the checks that hit any."""
    if not checks:
        return _no_issues(df)
    counts = [F.count_if(test).alias(f"k{i}") for i, (_, _, test, _) in enumerate(checks)]
    one = df.agg(F.count(F.lit(1)).alias("n"), *counts)
    rows = []
    for i, (name, issue, _, rule) in enumerate(checks):
        pct = share(F.col(f"k{i}"), F.col("n"))
        rows.append(
            F.struct(F.lit(name).alias("column"), F.lit(issue).alias("issue"), F.col(f"k{i}").alias("count"), pct.alias("pct"), rule(pct).alias("severity"))
        )
    return one.select(F.inline(F.array(*rows))).where("count > 0")


def _no_issues(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "column string, issue string, count bigint, pct double, severity string")


def _missing_checks(df: DataFrame) -> list[Check]:
    return [(n, ISSUE_MISSING, missing(df, n), severity) for n in df.columns]


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with NULLs (or NaN): count, percentage, severity and type; worst first."""
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    return (
        _run(df, _missing_checks(df))
        .select("column", F.col("count").alias("missing_count"), F.col("pct").alias("missing_pct"), "severity", types[F.col("column")].alias("dtype"))
        .orderBy(F.desc("missing_count"), "column")
    )


def _zero_checks(df: DataFrame, names: Sequence[str] | None = None) -> list[Check]:
    names = present(df, names or ZERO_COLUMNS)
    rule = lambda pct: F.when(pct > 50, "HIGH").otherwise("MEDIUM")
    return [(n, ISSUE_ZERO, F.coalesce(number(df, n), F.lit(0)) == 0, rule) for n in names]


def zero_report(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Zeros and NULLs both count."""
    return _run(df, _zero_checks(df, names))


def outlier_report(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Values beyond 1.5 IQR from the exact quartiles; columns without spread give no row."""
    names = list(names or numeric_columns(df))
    q = exact_quantiles(df, names, {"q1": 0.25, "q3": 0.75}).where("q3 <> q1")
    iqr = F.col("q3") - F.col("q1")
    # One row per named column, used twice.
    bounds = cut(q.withColumns({"iqr": iqr, "lower_bound": F.col("q1") - 1.5 * iqr, "upper_bound": F.col("q3") + 1.5 * iqr}))
    tagged = long_values(df, names).join(F.broadcast(bounds), "column")
    hits = tagged.groupBy("column").agg(
        F.count_if((F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))).alias("outliers")
    )
    return (
        bounds.join(hits, "column")
        .where("outliers > 0")
        .select(
            "column", *[half_even(F.col(c)).alias(c) for c in ("q1", "q3", "iqr", "lower_bound", "upper_bound")],
            "outliers", share(F.col("outliers"), F.col("n")).alias("outlier_pct"),
        )
    )


def _score_checks(df: DataFrame) -> list[Check]:
    checks: list[Check] = []
    for n in present(df, TEN_POINT_COLUMNS):
        v = number(df, n)
        checks.append((n, ISSUE_SCORE, (v < SCORES[0]) | (v > SCORES[1]), _fixed("HIGH")))
    if "sentiment_score" in df.columns:
        v = number(df, "sentiment_score")
        checks.append(("sentiment_score", ISSUE_SENTIMENT, (v < 0) | (v > 1), _fixed("HIGH")))
    return checks


def score_report(df: DataFrame) -> DataFrame:
    return _run(df, _score_checks(df))


def duplicate_report(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first per non-NULL value of each id column."""
    names = present(df, names or ID_CHECKED)
    if not names:
        return _no_issues(df)
    values = tall(df, [], [(n, as_text(df, n)) for n in names], "column", "value", "string").where("value IS NOT NULL")
    per_value = values.groupBy("column", fingerprint(F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("c"))
    found = per_value.groupBy("column").agg((F.sum("c") - F.count(F.lit(1))).alias("count")).where("count > 0")
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    level = F.when(F.col("column").isin("record_id", "url"), "HIGH").otherwise("MEDIUM")
    return found.select("column", F.lit(ISSUE_DUPLICATE).alias("issue"), "count", share(F.col("count"), total).alias("pct"), level.alias("severity"))


def _title_checks(df: DataFrame) -> list[Check]:
    if "title" not in df.columns:
        return [("title", ISSUE_TITLE_COLUMN, F.lit(True), _fixed("HIGH"))]
    raw = as_text(df, "title")
    title = tx.strip(F.coalesce(raw, F.lit("")))
    return [
        ("title", ISSUE_TITLE_MISSING, raw.isNull(), severity),
        ("title", ISSUE_TITLE_EMPTY, title == "", _fixed("MEDIUM")),
        ("title", ISSUE_TITLE_FORM, title.rlike(r"\A[^\p{L}\p{N}]+\z"), _fixed("MEDIUM")),
        ("title", ISSUE_TITLE_SHORT, F.char_length(title) < 5, _fixed("LOW")),
    ]


def title_report(df: DataFrame) -> DataFrame:
    return _run(df, _title_checks(df))


def _content_checks(df: DataFrame) -> list[Check]:
    name = first_present(df, CONTENT_COLUMNS)
    if name is None:
        return [("content_text", ISSUE_CONTENT_COLUMN, F.lit(True), _fixed("HIGH"))]
    body = tx.strip(F.coalesce(as_text(df, name), F.lit("")))
    return [
        (name, ISSUE_CONTENT_EMPTY, body == "", severity),
        (name, ISSUE_CONTENT_SHORT, F.char_length(body) < 30, lambda pct: F.when(pct > 10, "MEDIUM").otherwise("LOW")),
    ]


def content_report(df: DataFrame) -> DataFrame:
    return _run(df, _content_checks(df))


def _format_checks(df: DataFrame) -> list[Check]:
    checks: list[Check] = []
    for n in present(df, DATE_CHECKED):
        checks.append((n, ISSUE_DATE, col(n).isNotNull() & dates.parsed(df, n).isNull(), _fixed("MEDIUM")))
    for n in present(df, YEAR_CHECKED):
        y = number(df, n)
        checks.append((n, ISSUE_YEAR, (y < YEARS[0]) | (y > YEARS[1]), _fixed("MEDIUM")))
    return checks


def format_report(df: DataFrame) -> DataFrame:
    return _run(df, _format_checks(df))


def full_report(df: DataFrame) -> DataFrame:
    """All checks as (column, issue, count, pct, severity), worst first. The row-wise checks share
    one pass; duplicates and outliers need a grouping each."""
    row_checks = [*_missing_checks(df), *_zero_checks(df), *_score_checks(df), *_title_checks(df), *_content_checks(df), *_format_checks(df)]
    pct = F.col("outlier_pct")
    outliers = outlier_report(df).select(
        "column", F.lit(ISSUE_OUTLIER).alias("issue"), F.col("outliers").alias("count"), pct.alias("pct"), severity(pct).alias("severity")
    )
    rank = F.when(F.col("severity") == "HIGH", 0).when(F.col("severity") == "MEDIUM", 1).otherwise(2)
    return _run(df, row_checks).unionByName(duplicate_report(df)).unionByName(outliers).orderBy(rank, F.desc("pct"), "column", "issue")


def bad_dates(df: DataFrame, key: str, column: str = "published_date") -> DataFrame:
    """Non-NULL values that do not begin like YYYY-MM-DD."""
    value = tx.strip(as_text(df, column))
    return df.where(col(column).isNotNull() & ~value.rlike(r"^\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}")).select(
        col(key).alias("row_key"), F.lit(column).alias("column"), value.alias("value"), F.lit(ISSUE_DATE_TEXT).alias("issue")
    )


def bad_languages(df: DataFrame, key: str, column: str = "language") -> DataFrame:
    """Non-NULL values that are neither a two-letter code nor unknown."""
    name = first_present(df, [column, "original_language"])
    value = F.lower(tx.strip(as_text(df, name)))
    return df.where(col(name).isNotNull() & ~(value.rlike("^[a-z]{2}$") | (value == tx.UNKNOWN))).select(
        col(key).alias("row_key"), F.lit(name).alias("column"), value.alias("value"), F.lit(ISSUE_LANGUAGE_TEXT).alias("issue")
    )


def missing_matrix(df: DataFrame, key: str, rows: int = 200, seed: int = 42) -> DataFrame:
    """NULL flags of the columns that have gaps, for a repeatable sample of rows."""
    gaps = df.agg(*[F.count_if(missing(df, n)).alias(n) for n in df.columns]).first()
    names = [n for n in df.columns if gaps[n]]
    picked = df.orderBy(F.md5(F.concat_ws(":", col(key).cast("string"), F.lit(str(seed))).cast("binary")), col(key)).limit(rows)
    return picked.select(col(key), *[missing(df, n).alias(f"{n}_missing") for n in names])


def validate(df: DataFrame, key: str = "record_id") -> DataFrame:
    """Seven checks, one row each: violations and whether the check passed. One pass."""
    never = F.lit(False)
    title = tx.is_blank(as_text(df, "title")) if "title" in df.columns else F.lit(True)
    score = first_present(df, ["rating_score", "vote_average"])
    year = first_present(df, YEAR_CHECKED)
    language = first_present(df, ["language", "original_language"])
    lengths = never
    for n in present(df, ["content_length", "title_length"]):
        lengths = lengths | F.coalesce(number(df, n) < 0, never)

    def outside(name: str | None, low: float, high: float) -> Column:
        return never if name is None else F.coalesce(~number(df, name).between(low, high), never)

    code = F.lower(as_text(df, language)) if language else F.lit(tx.UNKNOWN)
    bad_code = F.coalesce(~(code.rlike("^[a-z]{2}$") | (code == tx.UNKNOWN)), never)
    absent = len([n for n in REQUIRED_COLUMNS if n not in df.columns])
    tests = {
        "null_titles": F.count_if(title),
        "rating_score_range": F.count_if(outside(score, *SCORES)),
        "year_range": F.count_if(outside(year, *YEARS)),
        "language_codes": F.count_if(bad_code),
        "content_length": F.count_if(lengths),
    }
    if key in df.columns:
        has_null = F.coalesce(F.max(F.when(col(key).isNull(), 1).otherwise(0)), F.lit(0))
        tests["duplicate_ids"] = (F.count(F.lit(1)) - F.count_distinct(col(key)) - has_null).cast("bigint")
    one = df.agg(*[c.alias(n) for n, c in tests.items()])
    rows = [F.struct(F.lit("required_columns").alias("check"), F.lit(absent).cast("bigint").alias("violations"))]
    rows += [F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in tests]
    if key not in df.columns:
        rows.append(F.struct(F.lit("duplicate_ids").alias("check"), F.lit(0).cast("bigint").alias("violations")))
    return one.select(F.inline(F.array(*rows))).select("check", "violations", (F.col("violations") == 0).alias("passed"))


class ValidationError(AssertionError):
    pass


def require_valid(df: DataFrame, key: str = "record_id") -> dict:
    """Runs :func:`validate`; raises if any check fails."""
    rows = validate(df, key).collect()
    failed = {r["check"]: r["violations"] for r in rows if not r["passed"]}
    if failed:
        raise ValidationError(f"{len(failed)} checks failed: {failed}")
    return {"passed": len(rows), "failed": 0}
