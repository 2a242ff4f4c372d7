"""Headline queries, each timed after a warm-up run; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkrec.plans.catalog import QUERIES  # noqa: E402
from sparkrec.session import build_session  # noqa: E402

HEADLINE = (
    "a4_read_staging", "c1_latest_products", "c2_latest_interactions", "c5_upsert", "c7_sync_counters", "d1_item_features", "d2_user_sequences",
    "e2_point_in_time", "f5_leave_one_out", "f5_leave_one_out_history", "f11_category_tokens", "f16_catalog_assembly", "g3_scores",
    "g4_top_n", "h1_catalog_ranks", "h2_ranks_in_scores", "h10_champion_ranks", "h14_early_stopping", "i2_top_k_similar", "i7_homepage",
    "j2_categorical_drift", "k2_recent_items_stream", "k3_sessions", "k4_request_rate", "k8_stream_upsert",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))  # timed runs after one warm-up run
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 16g pyspark-shell")
    spark = build_session(
        "bench", **{"spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus,
                    "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in wanted:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
