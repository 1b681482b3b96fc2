"""The panels of the dashboard as result frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.functions.text import shorten
from newsmill.operators import aggregates as agg
from newsmill.operators.clean import dashboard_rows
from newsmill.operators.select import faceted

TITLE_LENGTHS = {"chart": 70, "table": 95, "bars": 35}


def top_records(df: DataFrame, n: int = 10, key: str = "record_id", keep: Sequence[str] = ("title", "category", "popularity", "rating_score")) -> DataFrame:
    """Most popular records, best rated first on a tie, with the cut titles of the panels."""
    best = df.orderBy(F.desc("popularity"), F.desc("rating_score"), col(key)).limit(n).select(col(key), *[col(k) for k in keep if k != key])
    return best.withColumns(
        {
            "title_short": shorten(F.col("title"), TITLE_LENGTHS["chart"]),
            "title_cell": shorten(F.col("title"), TITLE_LENGTHS["table"]),
            "title_bar": F.left(F.col("title"), F.lit(TITLE_LENGTHS["bars"])),
        }
    )


def filtered(df: DataFrame, **facets) -> DataFrame:
    """Any article frame with the dashboard's defaults and facets applied."""
    return faceted(dashboard_rows(df), **facets)


def panels(df: DataFrame, n: int = 12, **facets) -> dict[str, DataFrame]:
    """All panels of one filtered input. Cache the input first if all of them will be drawn."""
    rows = faceted(df, **facets)
    means = {"rating_score": "avg_rating", "popularity": "avg_popularity"}
    return {
        "kpis": agg.kpi_row(rows),
        "top_records": top_records(rows, n),
        "rating_histogram": agg.histogram(rows, "rating_score", 30, ["category"]),
        "popularity_points": agg.scatter_data(rows, "content_length", "popularity", "rating_score", ["record_id", "category"]),
        "categories": agg.bar_data(rows, "category", {**means, "content_length": "avg_content_length"}),
        "document_types": agg.bar_data(rows, "document_type", means, 12),
        "years": agg.yearly_chart(rows, "published_year", means),
        "rating_box": agg.box_numbers(rows, "rating_score", "category"),
    }


def panel_sizes(df: DataFrame, **facets) -> DataFrame:
    """Rows per panel."""
    counts = [d.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("panel"), "rows") for name, d in panels(df, **facets).items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
