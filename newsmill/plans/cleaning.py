"""The whole cleaning run."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from newsmill.columns import col, missing, present
from newsmill.operators import clean, dedup
from newsmill.operators.ordering import keep_first
from newsmill.operators.quality import missing_report, require_valid
from newsmill.session import cut
from newsmill.sources.stores import write_results

# Columns whose zeros mean missing, and columns imputed by median.
ZERO_IS_MISSING = ["mentions", "sentiment_score", "rating_score", "popularity", "vote_average", "vote_count"]
IMPUTED = ["rating_score", "content_length", "title_length", "popularity", "vote_average", "vote_count"]


def clean_rows(df: DataFrame) -> DataFrame:
    """Row-wise steps up to the imputation: critical fields, strings, placeholders, zeros. One
    narrow stage without a shuffle."""
    return (
        df.transform(clean.drop_incomplete)
        .transform(clean.clean_strings)
        .transform(clean.fill_texts)
        .transform(clean.fill_overview)
        .transform(clean.zero_to_null, ZERO_IS_MISSING)
    )


_ROW = "_nm_row"


def _steps(stored: DataFrame, order: Sequence[str], arrival: Sequence[str]) -> dict[str, DataFrame]:
    """The rows left after each rule, as narrow frames: a row number, what the rules look at, and a
    fingerprint of the whole row. Texts that no rule looks at are not moved."""
    compared = stored.drop(_ROW)
    a, b = dedup.row_fingerprint(compared, arrival)
    names = present(compared, dict.fromkeys([*order, "url", "title", *dedup.DATE_COLUMNS, *dedup.ID_COLUMNS]))
    narrow = stored.select(_ROW, a.alias("_nm_a"), b.alias("_nm_b"), *[col(n) for n in names])
    equal = keep_first(narrow, [F.col("_nm_a"), F.col("_nm_b")], [*[col(o) for o in order], F.col(_ROW)]).drop("_nm_a", "_nm_b")
    url = dedup.by_url(equal, order, row=_ROW)
    title = dedup.by_title_and_date(url, order, row=_ROW)
    return {"equal_rows": equal, "url": url, "title_date": title, "id": dedup.by_id(title, [*order, _ROW])}


def _numbered(df: DataFrame) -> DataFrame:
    """The rows, stored, so that their numbers stay the same however often they are read."""
    return cut(df).withColumn(_ROW, F.monotonically_increasing_id())


def _imputed(df: DataFrame) -> DataFrame:
    """The rows with their numbers after the row-wise steps, stored; the medians come from what is stored."""
    return _numbered(df.transform(clean_rows)).transform(clean.fill_medians, IMPUTED)


def deduplicate(df: DataFrame, order: Sequence[str], arrival: Sequence[str] = ()) -> DataFrame:
    """Rows equal in every column (but ``arrival``), then URLs, then title and date, then ids.

    The rules work on row numbers; the full rows are stored once and joined once with what is left.
    """
    return _left(_numbered(df), order, arrival)


def _left(stored: DataFrame, order: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    left = _steps(stored, order, arrival)["id"].select(_ROW)
    return stored.join(left, _ROW, "left_semi").drop(_ROW)


def clean_all(df: DataFrame, order: Sequence[str], threshold: float = 0.60, check: bool = False, arrival: Sequence[str] = ()) -> DataFrame:
    """The eleven-step run. The source is read once: the rows are stored after the row-wise steps, and once more when
    they are unique; the shares of NULL are counted while these are written.

    ``order`` says which of several rows comes first. Every column counts when rows are compared, ids
    included; only columns in ``arrival``, made up to number the rows, do not.
    """
    unique = _left(_imputed(df), order, arrival)
    names = clean.unprotected(unique)
    if names:
        seen = Observation()
        unique = cut(unique.observe(seen, F.count(F.lit(1)).alias("_nm_rows"), *[F.count_if(missing(unique, n)).alias(n) for n in names]))
        sparse = [n for n in names if seen.get[n] > threshold * seen.get["_nm_rows"]]
    else:
        unique, sparse = cut(unique), []
    typed = unique.drop(*sparse).transform(clean.convert_types)
    if check:
        require_valid(typed)
    return typed


def clean_and_save(df: DataFrame, order: Sequence[str], folder: str, threshold: float = 0.60, arrival: Sequence[str] = ()) -> dict[str, str]:
    """The whole run with its files: the missing report of the input and the checked, cleaned rows."""
    results = {"missing_report": missing_report(df), "cleaned_data": clean_all(df, order, threshold, True, arrival)}
    return write_results(results, folder)


def step_counts(df: DataFrame, order: Sequence[str], arrival: Sequence[str] = ()) -> DataFrame:
    """Rows left after each deduplication step."""
    stored = _imputed(df)
    steps = {"input": stored} | _steps(stored, order, arrival)
    counts = [d.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("step"), "rows") for n, d in steps.items()]
    return reduce(DataFrame.unionByName, counts)
