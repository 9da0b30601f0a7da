"""Time the headline queries on the test tables and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from tidemark.registry import QUERIES
from tidemark.session import build_session

HEADLINES = [
    "log_month_counts", "log_month_counts_sql", "log_level_month_key", "log_time_text", "key_skew",
    "course_scores", "user_course_views", "project_filter", "pass_flags", "views_labels",
    "trial_labels", "lookup_left", "distinct_pairs", "group_counts", "group_sums", "top_n",
    "top_per_group", "pivot_sum", "describe_cols", "corr_target", "corr_matrix",
    "composite_key_audit", "common_words", "anti_words", "course_keywords", "string_index",
    "one_hot", "hash_split", "tumbling_2m", "sliding_2m_2s", "sliding_60m_1m",
    "stream_tumbling_sql", "stream_last_hour", "stream_leaderboard", "linreg_coefs", "reg_metrics",
    "class_metrics", "cluster_sse", "cluster_silhouette", "price_report", "logreg", "forest",
    "kmeans_sweep", "als_topk",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
