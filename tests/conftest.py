import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FOLDER = os.environ.get("NEWSMILL_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from newsmill.session import build_session

    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": 4,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture
def news(spark):
    """Five records with the usual faults."""
    rows = [
        (1, "  Election   Update (2026) ", "  <p>Election news text</p>  ", " Politics ", " news_api ", " EN ", 4.0, 10.0, 1.0, "2026-03-01", "https://example.com/a", 25, 28),
        (2, "AI Market Growth", None, "BUSINESS", "NEWS_API", "unknown", 0.0, 0.0, 0.0, "2026-03-02", "https://example.com/b", 0, 16),
        (2, "AI Market Growth", None, "BUSINESS", "NEWS_API", "unknown", 0.0, 0.0, 0.0, "2026-03-02", "https://example.com/b", 0, 16),
        (3, "", "   ", "sports", "excel", "bad-language", None, 5.0, 2.0, "invalid-date", None, 1, 0),
        (4, "Sports Highlights", "Sports story content", "SPORTS", "excel", None, 6.0, None, None, "2026-03-04", "https://example.com/c", 20, 17),
    ]
    schema = """record_id long, title string, content_text string, category string, document_type string, language string,
        rating_score double, popularity double, vote_count double, published_date string, url string, content_length long, title_length long"""
    df = spark.createDataFrame(rows, schema)
    from pyspark.sql import functions as F

    numbered = df.withColumn("seq", F.monotonically_increasing_id())
    return numbered.withColumns({"overview": F.col("content_text"), "vote_average": F.col("rating_score")})
