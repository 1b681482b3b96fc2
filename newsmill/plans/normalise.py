"""One canonical article row from any collected record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col, first_present, number, present, with_id
from newsmill.columns import text as as_text
from newsmill.functions import dates
from newsmill.functions import text as tx
from newsmill.functions.numbers import clip
from newsmill.operators.ingest import first_text

# Placeholders, text candidates in order, and the clues to an unknown document type.
UNTITLED = "Untitled record"
UNKNOWN = "unknown"
TEXT_CANDIDATES = ["description", "text", "processed_text", "raw_text", "preview_text", "content", "transcript", "content_text"]
TYPE_BY_SUFFIX = {".json": "json", ".pdf": "pdf", ".docx": "word", ".xlsx": "excel"}
TYPE_BY_PATH = {"news_page": "json", "scrapethissite.com/pages/forms": "scraped_html", "oscars|ajax": "scraped_json_api"}
TYPE_BY_URL = "news_api"


def _document_type(df: DataFrame) -> Column:
    name = first_present(df, ["document_type", "type"])
    given = F.coalesce(as_text(df, name), F.lit(UNKNOWN)) if name else F.lit(UNKNOWN)
    guess = F.when(F.lower(given) != UNKNOWN, given)
    if "file_name" in df.columns:
        for suffix, kind in TYPE_BY_SUFFIX.items():
            guess = guess.when(F.endswith(as_text(df, "file_name"), F.lit(suffix)), kind)
    if "source_path" in df.columns:
        for clue, kind in TYPE_BY_PATH.items():
            pattern = "(?iu)" + clue.replace(".", r"\.")
            guess = guess.when(as_text(df, "source_path").rlike(pattern), kind)
    if "url" in df.columns:
        guess = guess.when(col("url").isNotNull(), TYPE_BY_URL)
    return guess.otherwise(given)


def _title(df: DataFrame) -> Column:
    name = first_present(df, ["title", "name", "file_name"])
    if name is None:
        return F.lit(UNTITLED)
    given = F.coalesce(as_text(df, name), F.lit(UNTITLED))
    spare = F.coalesce(as_text(df, "file_name"), F.lit(UNTITLED)) if "file_name" in df.columns else F.lit(UNTITLED)
    return F.coalesce(F.when(tx.strip(given) != "", given), spare)


def _rating(df: DataFrame, length: Column) -> Column:
    """Sentiment times ten; else a given rating; else mentions scaled to 0–10; else text length."""
    ranks = []
    if "sentiment_score" in df.columns:
        ranks.append(number(df, "sentiment_score").cast("double") * 10)
    if "rating_score" in df.columns:
        ranks.append(number(df, "rating_score").cast("double"))
    if "mentions" in df.columns:
        m = number(df, "mentions").cast("double")
        limits = df.agg(F.min(m).alias("lo"), F.max(m).alias("hi"))
        lo, hi = limits.select("lo").scalar(), limits.select("hi").scalar()
        ranks.append(F.when(hi != lo, (m - lo) / (hi - lo) * 10))
    return F.coalesce(*ranks, clip(length / 1000 * 10, 0.0, 10.0))


def normalise(df: DataFrame, key: str | None = None) -> DataFrame:
    """The canonical columns beside the given ones.

    A fallback column is chosen by presence in the schema, not row by row. ``key`` names the
    record's own id where there is no ``record_id``; without either a hash of the row serves.
    """
    df = with_id(df.withColumn("record_id", col(key)) if key else df)
    source = first_present(df, ["source_name", "source", "source_path"])
    language = first_present(df, ["language", "original_language"])
    date = first_present(df, ["published_date", "publishedAt", "extraction_timestamp", "fetched_at"])
    base = df.withColumns(
        {
            "record_id": number(df, "record_id"),
            "document_type": _document_type(df),
            "title": _title(df),
            "source_name": F.coalesce(as_text(df, source), F.lit(UNKNOWN)) if source else F.lit(UNKNOWN),
            "language": F.coalesce(as_text(df, language), F.lit(UNKNOWN)) if language else F.lit(UNKNOWN),
            "published_date": dates.parsed(df, date) if date else F.lit(None).cast("timestamp"),
            "mentions": number(df, "mentions") if "mentions" in df.columns else F.lit(None).cast("double"),
            "url": col("url") if "url" in df.columns else F.lit(None).cast("string"),
        }
    )
    given = F.coalesce(as_text(df, "category"), F.lit(UNKNOWN)) if "category" in df.columns else col("document_type")
    category = F.when(F.lower(given) == UNKNOWN, col("document_type")).otherwise(given)
    body = first_text(base, TEXT_CANDIDATES, col("title"))
    if not present(df, TEXT_CANDIDATES):
        body = col("title")
    bodied = base.withColumns({"category": category, "content_text": body, "published_year": F.year("published_date")})
    sized = bodied.withColumns({"content_length": F.char_length("content_text"), "title_length": F.char_length("title")})
    rated = sized.withColumn("rating_score", _rating(df, col("content_length")))
    return rated.withColumns(
        {
            "overview": col("content_text"),
            "genres": col("category"),
            "popularity": F.coalesce(col("mentions"), col("content_length")).cast("double"),
            "release_date": col("published_date"),
            "release_year": col("published_year"),
            "original_language": col("language"),
            "vote_average": col("rating_score"),
            "vote_count": F.coalesce(col("mentions"), F.lit(1)).cast("double"),
        }
    )
