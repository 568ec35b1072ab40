"""Dyadic covers, interval joins on them, gap ranges, bit sets, trailing windows and bucketed stores."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bizlens.operators.coverage import drop_sparse, presence, sparse_rows
from bizlens.operators.impact import gap_ranges, missing_values
from bizlens.operators.joins import dyadic_cover, interval_join
from bizlens.operators.ledger import trailing_day_balances

D = dt.date


def test_cover_is_exact_disjoint_and_short(spark):
    rng = random.Random(1)
    spans = [(a, a + rng.choice([0, 1, 2, 7, 100, 5000])) for a in (rng.randint(-3000, 3000) for _ in range(80))] + [(-1, 0), (-8, 7), (0, 0)]
    got = spark.createDataFrame(spans, "a long, b long").select("a", "b", dyadic_cover(F.col("a"), F.col("b")).alias("c")).collect()
    for r in got:
        held = [x for c in r.c for x in range(c.block << c.level, (c.block + 1) << c.level)]
        assert sorted(held) == list(range(r.a, r.b + 1))
        assert len(r.c) <= 2 * max((r.b - r.a + 1).bit_length(), 1)
    day = 86400
    long = spark.sql(f"SELECT {-719162 * day}L a, {-719162 * day + 365_243 * day}L b").select(F.size(dyadic_cover(F.col("a"), F.col("b")))).first()[0]
    assert long < 80  # a thousand years in seconds


def cases():
    rng = random.Random(4)
    when = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randint(0, 10**7), microseconds=rng.choice([0, 5, 999_999]))
    day = lambda: D(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 90))
    number = lambda: rng.randint(-20, 20)
    real = lambda: rng.randint(-200, 200) / 8
    return {"timestamp_ntz": when, "timestamp": when, "date": day, "long": number, "int": number, "double": real}


@pytest.mark.parametrize("kind", sorted(cases()))
@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_of_every_type(spark, kind, how):
    make = cases()[kind]
    rng = random.Random(6)
    points = [(i, make()) for i in range(60)] + [(99, None)]
    points += [(100 + i, points[i][1]) for i in range(10)]  # equal points
    spans = [(i, *(sorted((make(), make())) if rng.random() < 0.8 else (make(), make()))) for i in range(40)] + [(90, None, make()), (91, make(), None)]
    spans += [(92, points[0][1], points[0][1])]
    p = spark.createDataFrame(points, f"id int, t {kind}")
    s = spark.createDataFrame(spans, f"span int, a {kind}, b {kind}")
    want = []
    for i, t in points:
        hits = [k for k, a, b in spans if None not in (t, a, b) and a <= t <= b]
        want += [(i, k) for k in hits] or ([(i, None)] if how == "left" else [])
    got = interval_join(p, s, "t", "a", "b", how).select("id", "span").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_interval_join_is_an_equi_join(spark):
    p = spark.range(1000).select((F.col("id") * 10).alias("t"))
    s = spark.range(1000).select("id", F.col("id").alias("a"), (F.col("id") + 10**12).alias("b"))
    plan = interval_join(p, s, "t", "a", "b", "inner")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = s.limit(0)
    assert interval_join(p, none, "t", "a", "b", "left").count() == 1000 and interval_join(p, none, "t", "a", "b", "inner").count() == 0


def test_gap_ranges(spark):
    rng = random.Random(2)
    lo, hi = -(2**63), 2**63 - 1
    for values in ([], [lo], [hi], [lo, hi], [5, 5, None, 6, 9], [rng.randint(lo, hi) for _ in range(200)]):
        df = spark.createDataFrame([(v,) for v in values], "v long")
        got = sorted(map(tuple, gap_ranges(df, "v", lo, hi).collect()))
        want, at = [], lo
        for v in sorted({v for v in values if v is not None}):
            want += [(at, v - 1)] if at < v else []
            at = v + 1
        assert got == want + ([(at, hi)] if at <= hi else [])
    df = spark.createDataFrame([(g, v) for g in ("a", None) for v in ([1, 4, 9] if g else [2])] + [("c", None), ("d", 77)], "g string, v int")
    got = sorted(map(tuple, gap_ranges(df, "v", 1, 6, by="g").collect()), key=repr)
    assert got == sorted([("a", 2, 3), ("a", 5, 6), (None, 1, 1), (None, 3, 6), ("c", 1, 6), ("d", 1, 6)], key=repr)
    assert sorted(r.m for r in missing_values(df, "v", 1, 6, "m").collect()) == [3, 5, 6]


def test_presence_from_bit_sets(spark):
    rng = random.Random(7)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([None, rng.randint(-300, 300), rng.randint(0, 9)])) for _ in range(500)] + [(8, None)]
    df = spark.createDataFrame(rows, "e int, p int").withColumn("m", F.add_months(F.lit(D(2018, 7, 1)), F.col("p")))
    for col in ("p", "m"):
        want = {e: len({p for x, p in rows if x == e and p is not None}) for e, _ in rows}
        assert {r.e: r.n for r in presence(df, "e", col, "n").collect()} == want
    few = {e for e in want if e is not None and want[e] < 150}
    assert sparse_rows(df, "e", "m", 150, "n").first().n == sum(e in few for e, _ in rows)
    assert drop_sparse(df, "e", "p", 150).filter("e = 8").count() == 1  # the rows to be dropped


@pytest.mark.parametrize("days", [1, 7, 30, 90, 365])
def test_trailing_balances_equal_a_row_per_day(spark, days):
    rng = random.Random(days)
    rows = [(rng.choice([1, 2, None]), D(2023, 1, 1) + dt.timedelta(days=rng.randint(0, 500)), rng.choice(["deposit", "purchase"]), rng.randint(1, 900)) for _ in range(60)] + [(1, None, "deposit", 5)]
    got = {(r.customer_id, r.month): r.day_balances for r in trailing_day_balances(spark.createDataFrame(rows, "customer_id int, txn_date date, txn_type string, txn_amount int"), days).collect()}
    last, want = max(d for _, d, *_ in rows if d).replace(day=1), {}
    for c in (1, 2, None):
        own = [(d, a if k == "deposit" else -a) for x, d, k, a in rows if x == c and d]
        month = min(own)[0].replace(day=1)
        while month <= last:
            following = (month + dt.timedelta(days=32)).replace(day=1)
            held = [following - dt.timedelta(days=k + 1) for k in range(days)]
            want[c, month] = sum(a for day in held for d, a in own if d <= day)
            month = following
    assert got == want


def test_bucketed_store_joins_without_an_exchange(spark, small_dir):
    from bizlens.plans import spark_queries, store_tables

    with store_tables(spark, small_dir, ("sales", "customer_nodes", "click_events", "product_analysis"), buckets=4) as store:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            per = store.read("sales").groupBy("customer_id").agg(F.count("*").alias("n"))
            plan = per.join(store.read("customer_nodes"), "customer_id")._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            clicks = store.read("click_events")
            visits = clicks.groupBy("visit_id").agg(F.min("event_time").alias("first"))
            plan = clicks.join(visits, "visit_id")._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("most_viewed", "first_after_join", "visit_summary_intended", "avg_view_to_cart"):
            want = sorted(map(tuple, spark_queries()[name](spark, small_dir).collect()), key=repr)
            assert sorted(map(tuple, spark_queries(store)[name](spark, small_dir).collect()), key=repr) == want
        tables = {t.name for t in spark.catalog.listTables() if t.name.startswith("store_")}
        assert len(tables) == 3
    assert not {t.name for t in spark.catalog.listTables() if t.name.startswith("store_")}


def test_kept_result_tables_can_be_stored(spark, small_dir):
    from bizlens.plans import spark_queries, store_tables

    with store_tables(spark, small_dir, ("weekly_sales", "clean_weekly_sales", "interest_metrics_dated", "product_analysis")) as store:
        for name in ("clean_weekly_sales", "weekday_used", "typed_month_year", "best_view_to_purchase"):
            df = spark_queries(store)[name](spark, small_dir)
            assert store.path.split("/")[-1] in df._jdf.queryExecution().executedPlan().toString() or any(store.path.split("/")[-1] in f for f in df.inputFiles())
            assert sorted(map(tuple, df.collect()), key=repr) == sorted(map(tuple, spark_queries()[name](spark, small_dir).collect()), key=repr)
