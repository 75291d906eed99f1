"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
local cores. Every query is run once to warm up and then BENCH_RUNS times
(default 1); the median counts. Results are counted by a no-op write, so all
columns of all rows are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "category_trends",
    "weekly_breakdown",
    "sample_posts",
    "sentiment_scores",
    "sentiment_rules",
    "brand_whitelist",
    "brand_hits",
    "brand_trends",
    "clean_mentions",
    "incremental_ingest",
    "archive_posts",
    "content_dedup",
    "embed_text",
    "knn_graph",
    "density_cluster",
    "stored_dashboard",
]


def main() -> None:
    from checks.registry import QUERIES
    from trendloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    took = {}
    for name in names:
        once(name)
        took[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
