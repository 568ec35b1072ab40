"""Summarise the physical plans of the headline queries (python -m tests.plan_report).

For each query: shuffles (hash exchanges and their keys), broadcasts, join
strategies, window partition keys and aggregate steps, read from the initial
adaptive plan at the given scale. Used to write PLANS.md.
"""

from __future__ import annotations

import re
import sys
from collections import Counter


def summarise(plan: str) -> dict:
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)
    keys = [re.sub(r"#\d+L?", "", k) for k in shuffles]
    joins = Counter(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)"
                               r"[^\n]*?(Inner|LeftOuter|LeftSemi|LeftAnti|RightOuter|FullOuter)", plan))
    windows = [re.sub(r"#\d+L?", "", w) for w in re.findall(r"\n[ :+-]*Window \[.*?\], \[([^\]]*)\]", plan)]
    return {
        "shuffles": keys,
        "single_partition": plan.count("Exchange SinglePartition"),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": dict(Counter(f"{a} {b}" for (a, b), n in joins.items() for _ in range(n))),
        "window_keys": windows,
        "partial_aggs": len(re.findall(r"functions=\[partial_", plan)),
        "window_group_limit": plan.count("WindowGroupLimit"),
        "expand": plan.count("Expand "),
        "scans": len(re.findall(r"FileScan parquet", plan)),
    }


def main(argv=None) -> None:
    from bench import HEADLINE
    from bizlens.plans import spark_queries
    from bizlens.session import local_session

    sf = (argv or sys.argv[1:] or ["/root/testdata/sf0.1"])[0]
    spark = local_session(8, 16)
    qs = spark_queries()
    for name in HEADLINE:
        plan = qs[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"### {name}")
        print(f"- scans: {s['scans']}; shuffles: {len(s['shuffles'])} "
              f"({'; '.join(s['shuffles']) or '-'}); single-partition: {s['single_partition']}")
        print(f"- broadcasts: {s['broadcasts']}; joins: "
              f"{', '.join(f'{k} x{v}' for k, v in s['joins'].items()) or '-'}")
        print(f"- partial aggregates: {s['partial_aggs']}; windows by: "
              f"{'; '.join(s['window_keys']) or '-'}; WindowGroupLimit: {s['window_group_limit']}; "
              f"Expand: {s['expand']}")
        print()


if __name__ == "__main__":
    main()
