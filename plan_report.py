"""Write PLANS.md: the physical plan shape of every registered query.

Plans are taken with broadcasts turned off (as at 100 TB, where no side is
small) and AQE off (so the static plan is shown): the number of shuffles,
the join strategies, whether top-1 windows are limited before the shuffle,
and the aggregation kinds.  Usage: python plan_report.py [sf_dir]
"""

from __future__ import annotations

import re
import sys

import star_queries as E
from fleetlake.session import build_session

PATTERNS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning",
    "single": r"Exchange SinglePartition",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "group_limit": r"WindowGroupLimit .*Partial",
    "windows": r"\bWindow \[",
    "hash_agg": r"\bHashAggregate\(",
    "sort_agg": r"SortAggregate\(",
    "object_agg": r"ObjectHashAggregate\(",
    "python": r"BatchEvalPython|ArrowEvalPython",
    "cartesian": r"CartesianProduct|BroadcastNestedLoopJoin",
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[4]", 8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    rows = []
    for name, fn in E.queries().items():
        if name == "run_manifest":
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        rows.append((name, {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}))
    cols = list(PATTERNS)
    out = ["# PLANS", "",
           "Physical plan shape of each registered query (generated by `plan_report.py`), with",
           "broadcast joins turned off and AQE off, i.e. the static plan as it would start on a",
           "cluster where no side is small. Counts include the adapter views that shape the test",
           "tables (their joins and aggregations are part of every plan). `group_limit` counts",
           "`WindowGroupLimit` nodes running before a shuffle (top-1 per key cut map-side).",
           "`python` and `cartesian` must be 0. At run time AQE turns small sides into broadcast",
           "joins and splits skewed partitions.", "",
           "| query | " + " | ".join(cols) + " |", "|---|" + "---|" * len(cols)]
    for name, c in rows:
        out.append(f"| {name} | " + " | ".join(str(c[k]) for k in cols) + " |")
    open("PLANS.md", "w").write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
