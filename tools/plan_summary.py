"""Print the physical plans of the headline queries, reduced to the operators
that matter for scale (scans with pushed filters, exchanges, joins,
aggregates, windows, generators).  AQE is off here so the static plan is
shown; at runtime AQE may coalesce partitions or switch a join strategy.

    python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyhouse.plans import bench_tables as B  # noqa: E402
from tallyhouse.session import local_session  # noqa: E402

KEEP = ("Exchange", "Join", "Aggregate", "Window", "Generate", "Scan", "Union", "Filter")
QUERIES = {
    "deal_metrics": B.deal_metrics,
    "listing_metrics": B.listing_metrics,
    "word_count": B.word_count,
}


def summarize(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if not any(k in line for k in KEEP):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        line = re.sub(r"functions=\[.*?\]\)?, output=.*", "...)", line)
        line = re.sub(r"Location: .*?,", "", line)
        out.append(line[:200].rstrip())
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print("# Physical plans (static, AQE off) of the headline queries\n")
    print(f"Generated by `tools/plan_summary.py` on `{sf_dir}`.\n")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        lines = summarize(plan)
        shuffles = sum(1 for ln in lines if "Exchange hashpartitioning" in ln or "Exchange rangepartitioning" in ln)
        reused = sum(1 for ln in lines if "ReusedExchange" in ln)
        bcast = sum(1 for ln in lines if "BroadcastExchange" in ln)
        print(f"## {name}\n\nshuffle exchanges: {shuffles}, broadcasts: {bcast}, reused exchanges: {reused}\n")
        print("```")
        print("\n".join(lines))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
