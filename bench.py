"""Time the headline queries. Prints one JSON line.

    BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_RUNS     timed runs per query after one warm-up run (default 1)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from wayfare.plans.catalog import QUERIES
from wayfare.session import build_session

HEADLINE = (
    "sentiment_join", "location_stats", "place_statistics", "date_range", "dedupe_first", "cap_per_rating", "newest_n",
    "dataset_stats", "value_shares", "cluster_profile", "cluster_quality", "scan_review_json", "scan_csv_format",
    "load_with_rejects", "flatten_nested", "extract_page_records", "url_parts", "json_repair", "entity_extract", "term_refine",
    "edges_reviews", "triplet_query", "pattern_table", "vector_topk", "vector_topk_filtered", "vector_fallback", "related_clusters",
    "calinski_harabasz", "davies_bouldin", "silhouette_squared", "day_plan", "synthetic_plan", "profile_table",
)


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
