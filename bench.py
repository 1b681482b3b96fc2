"""Times the headline queries and prints one JSON line: the median of ``BENCH_RUNS`` runs (3) of each, after one
untimed run that compiles its code and starts the Python workers."""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from newsmill.plans.catalogue import CATALOGUE  # noqa: E402
from newsmill.session import build_session  # noqa: E402

HEADLINE = [
    "yearly_summary", "category_summary", "rating_at_least", "term_counts", "faceted_search", "join_inner", "join_outer",
    "order_customer_join", "join_counts", "group_means", "top_per_group", "pivot_year_status", "crosstab_status_decade",
    "melt_metrics", "monthly_series", "rolling_means", "describe_numbers", "outlier_report", "histogram", "correlations",
    "value_counts", "clean_bodies", "clean_strings", "full_report", "clean_all", "distinct_rows", "first_per_url",
    "normalise_documents", "keyword_search", "vector_search", "multi_vector_search", "hybrid_search", "html_rows",
    "shifted_segments", "live_ticks",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds = {}
    for name in HEADLINE:
        took = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            CATALOGUE[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        seconds[name] = round(median(took[1:]), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
