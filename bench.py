"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (the whole plan runs,
nothing is collected to the driver). One warm-up query runs first. With
BENCH_STORE=1 (default) the joined and numbered domain tables are stored once
before the queries; ``stored_tables`` gives the seconds of each and
``prepare_sec`` their sum, which ``value`` includes. With BENCH_STORE=0 every
query derives what it reads.
Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf", ...}.

BENCH_QUERIES=all (default) runs every registered query; BENCH_QUERIES=headline
runs the headline set only; a comma list runs those names.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HEADLINE = [
    "spend_per_customer", "member_order_ranking", "first_after_join", "ingredient_list",
    "delivery_report", "plans_at_date", "days_to_annual", "running_balance", "allocation_average",
    "clean_weekly_sales", "impact_by_area", "product_funnel", "visit_summary_intended", "interest_rows",
    "cumulative_pct_by_months",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    which = os.environ.get("BENCH_QUERIES", "all")

    from bizlens.plans import spark_queries
    from bizlens.session import local_session

    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(2 * cpus, 8))))
    spark = local_session(cpus, parts, app="bizlens-bench")
    qs = spark_queries()
    if which == "all":
        names = sorted(qs)
    elif which == "headline":
        names = [n for n in HEADLINE if n in qs]
    else:
        names = [n for n in which.split(",") if n in qs]

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run(names[0])  # warm-up: JVM, code generation caches
    from bizlens.plans import store_tables
    stored, store = {}, None
    if os.environ.get("BENCH_STORE", "1") != "0":
        store = store_tables(spark, sf_dir, took=stored)
        qs = spark_queries(store)
    prepare = sum(stored.values())
    times, failed = {}, {}
    for n in names:
        try:
            times[n] = round(run(n), 3)
        except Exception as e:  # keep going, report the failure
            failed[n] = f"{type(e).__name__}: {str(e)[:200]}"
    head = [times[n] for n in HEADLINE if n in times]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_time" if which == "all" else "headline_query_time",
        "value": round(sum(times.values()) + prepare, 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "n_queries": len(times),
        "prepare_sec": round(prepare, 3),
        "stored_tables": stored,
        "headline_sec": round(sum(head), 3),
        "cpus": cpus,
    }
    if failed:
        out["failed"] = failed
    if store is not None:
        store.drop()
    print(json.dumps(out))
    spark.stop()
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
