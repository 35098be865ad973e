"""Headline-query benchmark: prints ONE JSON line.

Runs the registered queries that the baseline names (feature preparation,
each split, reference statistics, ROC-AUC / AP, gates + leaderboard, boosted
model fit and score) on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.
Each result is fully computed with the ``noop`` sink (no driver transfer);
the value per query is the median of ``$BENCH_REPEATS`` runs after a warm-up.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "prepare_frame", "split_by_flag", "latest_run_delta", "time_split_3way", "stratified_split_counts",
    "sequential_split", "capped_time_splits", "reference_stats", "impute_scale", "binary_metrics",
    "roc_auc", "average_precision", "lineitem_ranking", "quality_gates", "production_regression",
    "leaderboard", "batch_score",
]


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from plover.plans.catalog import QUERIES
    from plover.session import build_session
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    names = only or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]
        run_once(spark, fn, sf_dir)  # warm-up
        samples = [run_once(spark, fn, sf_dir) for _ in range(repeats)]
        times[name] = round(statistics.median(samples), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
