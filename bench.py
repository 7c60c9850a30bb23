"""Benchmark: wall seconds of the headline queries at $BENCH_SF_DIR on
local[$BENCH_CPUS].  Each query is fully executed through the no-op sink (no
driver collect).  Prints ONE JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pantry.plans import load_all  # noqa: E402
from pantry.session import build_session  # noqa: E402

HEADLINE = [
    "enrich_recipes", "training_table", "user_features", "time_split", "dataset_manifest",
    "ndcg_exp", "fairness_report", "score_popularity", "dq_rule_suite", "dq_builtin_suite",
    "rule_candidates", "candidate_meals", "fallback_rank", "ks_drift", "error_rate_5m",
    "p95_latency_5m", "throughput_rate", "latency_percentiles", "alert_sustained", "rank_predictions",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * cpus)), app_name="pantry-bench")
    reg = load_all()
    # warm-up (JIT / codegen caches) on the smallest fixture, not timed
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        reg["training_table"].build(spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        reg[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
