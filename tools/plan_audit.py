"""Static physical-plan summary of every registered query (AQE off).

usage: python tools/plan_audit.py [sf_dir]
Per query: hash shuffles, single-partition exchanges, broadcasts, parquet
scans and how many of them carry pushed event-type filters, plus any operator
that should not appear (cartesian / nested-loop joins, sort or Python
aggregation).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate", "ObjectHashAggregate",
             "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"]


def audit(spark, sf_dir: str) -> dict[str, dict]:
    from tidemark.plans.queries import QUERIES

    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = {}
    try:
        for name, fn in QUERIES.items():
            plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
            scans = re.findall(r"FileScan parquet [^\n]*", plan)
            out[name] = {
                "shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
                "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
                "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
                "scans": len(scans),
                "pushed": sum(1 for sc in scans if re.search(r"PushedFilters: \[[^\]]*(EqualTo|In)\(", sc)),
                "forbidden": [op for op in FORBIDDEN if op in plan],
            }
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    return out


if __name__ == "__main__":
    from tidemark.session import get_session

    spark = get_session(shuffle_partitions=8)
    for name, r in audit(spark, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01").items():
        print(f"{name:26s} " + " ".join(f"{k}={v}" for k, v in r.items()))
