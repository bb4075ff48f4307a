"""Final-plan summary of every registered query (markdown table on stdout).

Runs each query into the ``noop`` sink and reads the final adaptive plan:
parquet scans, shuffle exchanges, broadcast exchanges, sort-merge joins,
partial aggregates (map-side combine) and window-group limits. Streaming
queries are listed with the plan of their sink read-back; their streaming
plans are asserted in ``tests/test_plans.py``.
Usage: ``python tools/plan_report.py <sf_dir>``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.plans.catalog import QUERIES  # noqa: E402
from tidewater.session import build_session  # noqa: E402


def stats(plan: str) -> dict[str, int]:
    shuffles = (plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition")
                + plan.count("Exchange RoundRobinPartitioning")
                + plan.count("Exchange rangepartitioning"))
    return {
        "scans": plan.count("FileScan "),
        "shuffles": shuffles,
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "partial_agg": int("partial_" in plan),
        "group_limit": plan.count("WindowGroupLimit"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", app="tidewater-plans", shuffle_partitions=16)
    cols = ["scans", "shuffles", "broadcasts", "smj", "partial_agg", "group_limit"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        s = stats(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
