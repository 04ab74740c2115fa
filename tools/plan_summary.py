"""Print the physical operators of the headline queries (exchanges, joins, aggregates, windows).

usage: python tools/plan_summary.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from affinity.plans import catalog  # noqa: E402
from affinity.session import get_spark  # noqa: E402

DEFAULT = ["customer_features", "product_features", "training_set", "recommendations", "evaluation_report"]
KINDS = ["Exchange hashpartitioning", "Exchange SinglePartition", "Exchange RoundRobinPartitioning",
         "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
         "ObjectHashAggregate", "HashAggregate", "SortAggregate", "WindowGroupLimit", "Window ", "Expand", "Generate",
         "PythonUDF", "BatchEvalPython", "ArrowEvalPython"]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    spark = get_spark(master="local[8]", shuffle_partitions=16)
    for name in names:
        plan = catalog.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        counts = Counter({k.strip(): len(re.findall(re.escape(k), plan)) for k in KINDS})
        keys = sorted(set(re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)))
        keys = sorted({re.sub(r"#\d+L?", "", k) for k in keys})
        print(f"{name}: " + ", ".join(f"{k}={v}" for k, v in counts.items() if v))
        print(f"    shuffle keys: {keys}")
    spark.stop()


if __name__ == "__main__":
    main()
