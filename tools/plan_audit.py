"""Print a one-line plan summary per registered query: shuffles, join kinds,
single-partition steps, Python evaluation, and what reaches the Parquet scan.

Usage: python tools/plan_audit.py [sf_dir] [key-regex]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedlens.plans import catalog  # noqa: E402
from feedlens.session import build_session  # noqa: E402

PATTERNS = {
    "shuffle": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin",
    "single": r"Exchange SinglePartition",
    "bcast": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "bnlj": r"BroadcastNestedLoopJoin",
    "cartesian": r"CartesianProduct",
    "window": r"\bWindow\b",
    "python": r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas",
    "generate": r"\bGenerate\b",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    pat = re.compile(sys.argv[2]) if len(sys.argv) > 2 else None
    spark = build_session()
    for name, q in sorted(catalog.queries().items()):
        if pat and not pat.search(name):
            continue
        df = q(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = {k: len(re.findall(v, plan)) for k, v in PATTERNS.items()}
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))))
        flags = " ".join(f"{k}={v}" for k, v in counts.items() if v)
        print(f"{name:26s} {flags}")
        for s in schemas:
            print(f"{'':26s}   scan {s}")
    spark.stop()


if __name__ == "__main__":
    main()
