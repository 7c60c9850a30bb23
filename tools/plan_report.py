"""Physical-plan shape of every registered query (or the ones named).

usage: python tools/plan_report.py [sf_dir] [name ...]
Prints, per query, the counts of join strategies, exchanges, windows and the
operators the scale rules restrict (BroadcastNestedLoopJoin, Cartesian,
single-partition exchanges).  Nested-loop joins are expected only against
one-row aggregates or bounded samples; single-partition exchanges only for
final global aggregates or windows over small derived tables.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pantry.plans import load_all  # noqa: E402
from pantry.session import build_session  # noqa: E402

KINDS = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "Exchange hashpartitioning", "Exchange rangepartitioning",
         "Exchange SinglePartition", "Window", "WindowGroupLimit"]
STREAMING_OR_SINKS = {"drift_stream", "feedback_attribution_stream", "error_rate_5m_stream",
                      "latency_histogram_stream"}


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.001"
    names = [a for a in args if not a.startswith("/")]
    spark = build_session(master="local[*]", shuffle_partitions=8)
    reg = load_all()
    print("query," + ",".join(k.replace("Exchange ", "X:") for k in KINDS))
    for name in names or sorted(reg):
        if name in STREAMING_OR_SINKS and not names:
            continue
        plan = reg[name].build(spark, sf)._jdf.queryExecution().executedPlan().toString()
        print(name + "," + ",".join(str(plan.count(k)) for k in KINDS))


if __name__ == "__main__":
    main()
