"""Execute headline queries and summarize their final (AQE) physical plans as markdown.

    python tools/plan_report.py [--sf /root/testdata/sf0.1] > PLANS.md
"""

from __future__ import annotations

import argparse
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

KINDS = ["Exchange hashpartitioning", "Exchange SinglePartition", "BroadcastExchange", "BroadcastHashJoin",
         "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate",
         "ObjectHashAggregate", "SortAggregate", "Window", "Expand", "Generate", "FileScan parquet",
         "Scan ExistingRDD", "BatchEvalPython", "ArrowEvalPython"]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("keys", nargs="*", default=["umd_month", "umd_day", "five_factor_month", "five_factor_day",
                                                "report_table", "bucket_mom"])
    a = ap.parse_args()
    from panelfactors.plans.queries import QUERIES
    from panelfactors.session import local_session
    spark = local_session(8, 16)
    print(f"# Final physical plans (AQE, after execution) at `{a.sf}`\n")
    print("Counts of operators in each query's final adaptive plan, and its parquet scans."
          " Produced by `tools/plan_report.py`.\n")
    for k in a.keys:
        df = QUERIES[k](spark, a.sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {k}\n")
        counts = {kind: len(re.findall(re.escape(kind), plan)) for kind in KINDS}
        print("| operator | count |\n|---|---|")
        for kind, n in counts.items():
            if n:
                print(f"| {kind} | {n} |")
        scans = set()
        for ln in plan.splitlines():
            if "FileScan parquet" not in ln:
                continue
            ln = re.sub(r"#\d+L?", "", ln)
            cols = re.search(r"FileScan parquet \[([^\]]*)\]", ln)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", ln)
            loc = re.search(r"finance-tables-[0-9a-f]+/(\w+)|sf[0-9.]+/(\w+)\.parquet", ln)
            name = (loc.group(1) or loc.group(2)) if loc else "?"
            scans.add((name, cols.group(1) if cols else "?", pushed.group(1) if pushed else "?"))
        print("\nScans (pruned read schema, pushed filters):\n")
        for name, cols, pushed in sorted(scans):
            print(f"- columns [{cols}], pushed {pushed}")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
