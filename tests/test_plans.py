"""The scale contract of every query, read from its physical plan:
no Python UDF on the hot path, no cartesian product, nested-loop joins only
against small local lookup tables, and every parquet scan column-pruned."""

import re

import pytest

from bizlens.plans import spark_queries

QUERIES = spark_queries()


def _depth(line: str) -> int:
    m = re.search(r"[+:]- ", line)
    return m.start() if m else -1


def nested_loop_build_sides(plan: str):
    """Text of the build-side subtree of every BroadcastNestedLoopJoin."""
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "BroadcastNestedLoopJoin" not in line:
            continue
        d = _depth(line)
        build_right = "BuildRight" in line
        kids = [j for j in range(i + 1, len(lines)) if _depth(lines[j]) == d + 3]
        stop = next((j for j in range(i + 1, len(lines)) if 0 <= _depth(lines[j]) <= d), len(lines))
        kids = [j for j in kids if j < stop]
        start = kids[-1] if build_right else kids[0]
        end = stop if build_right else kids[1]
        yield "\n".join(lines[start:end])


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Plans as for tables that are too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def exchanges(spark, small_dir, name):
    """Each hash exchange's keys and what feeds it (past projections and sorts)."""
    lines = QUERIES[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString().split("\n")
    for i, line in enumerate(lines):
        m = re.search(r"Exchange hashpartitioning\(([^)]*), \d+\)", line)
        if m:
            below = next(x for x in lines[i + 1 :] if not re.search(r"Project|Sort |Filter", x))
            yield re.sub(r"#\d+L?", "", m.group(1)), below


@pytest.mark.parametrize("name, key", [
    ("visit_summary_intended", "cookie_id"), ("visit_summary", "cookie_id"),
    ("most_purchased_item", "product_id"), ("favourite_item", "product_id"), ("types_per_customer", "pizza_id"),
    ("records_per_interest", "interest_id"), ("before_created", "interest_id"), ("ids_not_in_map", "interest_id"),
    ("avg_pickup_minutes", "order_id")])
def test_rows_are_reduced_before_they_are_joined(spark, small_dir, no_broadcast, name, key):
    fed = [below for keys, below in exchanges(spark, small_dir, name) if keys.startswith(key)]
    assert fed
    raw = [b for b in fed if "lineitem" in b or "events" in b]
    assert not raw, raw


def test_views_meet_no_visit(spark, small_dir, no_broadcast):
    """What crosses the network by visit is carts and purchases, counted."""
    for name in ("product_funnel", "category_funnel", "product_funnel_intended"):
        by_visit = [below for keys, below in exchanges(spark, small_dir, name) if keys.startswith("visit_id")]
        aggregated = [b for b in by_visit if "Aggregate" in b]
        assert len(aggregated) >= 2, by_visit  # cart adds per visit and page, purchases per visit


def test_ranking_joins_members_once(spark, small_dir, no_broadcast):
    plan = QUERIES["member_order_ranking"](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[c_custkey", plan)) == 1


def test_no_window_without_partition_over_rows(spark, small_dir, no_broadcast):
    """Unpartitioned windows see bounded aggregates only: ranges of a count."""
    for name in ("cumulative_pct_by_months", "running_balance_stats", "allocation_average"):
        plan = QUERIES[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
        single = [i for i, x in enumerate(plan.split("\n")) if "Exchange SinglePartition" in x]
        for i in single:
            assert any("Aggregate" in x for x in plan.split("\n")[i + 1 : i + 4])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_is_cluster_safe(spark, small_dir, name):
    plan = QUERIES[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, "row-at-a-time Python"
    assert "CartesianProduct" not in plan
    for side in nested_loop_build_sides(plan):
        # the broadcast side of every nested loop join is a local lookup table
        assert "LocalTableScan" in side and "FileScan" not in side, side[:300]
    for scan in re.findall(r"FileScan parquet [^\n]*", plan):
        cols = re.search(r"ReadSchema: struct<([^>]*)>", scan)
        assert cols is None or cols.group(1).count(":") <= 8, "scan reads too many columns: " + scan[:200]
