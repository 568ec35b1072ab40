"""Operator properties on small literal inputs: ties, open intervals, NULL
semantics, as-of sides, running balances, shares and funnels."""

import datetime as dt

from pyspark.sql import functions as F

from bizlens.operators.aggregate import share_of_total, total_by
from bizlens.operators.coverage import drop_sparse, null_share, reference_gap
from bizlens.operators.impact import before_after, missing_values
from bizlens.operators.joins import interval_join
from bizlens.operators.ledger import running_balance
from bizlens.operators.rank import argmax_with_ties, top_k, top_per_group
from bizlens.operators.temporal import extreme_rows, nearest_event, time_in_state

D = dt.date


def test_top_per_group_keeps_ties(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "b", 3), (1, "c", 1), (2, "a", 5)], "k int, p string, n int")
    got = sorted(tuple(r) for r in top_per_group(df, ["k"], [F.desc("n")], 1, ties=True).collect())
    assert got == [(1, "a", 3), (1, "b", 3), (2, "a", 5)]
    one = top_per_group(df, ["k"], [F.desc("n"), F.asc("p")], 1, ties=False).collect()
    assert sorted(tuple(r) for r in one) == [(1, "a", 3), (2, "a", 5)]


def test_top_k_and_argmax(spark):
    df = spark.createDataFrame([("x", 2), ("y", 5), ("z", 5)], "p string, n int")
    assert [r.p for r in top_k(df, [F.desc("n"), F.asc("p")], 1).collect()] == ["y"]
    assert sorted(r.p for r in argmax_with_ties(df, "n").collect()) == ["y", "z"]


def test_nearest_event_sides_and_ties(spark):
    ev = spark.createDataFrame([(1, D(2021, 1, 1), "a"), (1, D(2021, 1, 7), "b"), (1, D(2021, 1, 10), "c"),
                                (1, D(2021, 1, 10), "d"), (2, D(2021, 1, 3), "e")], "k int, t date, p string")
    anchors = spark.createDataFrame([(1, D(2021, 1, 7)), (3, D(2021, 1, 1))], "k int, at date")
    after = sorted(r.p for r in nearest_event(ev, anchors, "k", "t", "at", "after").collect())
    before = sorted(r.p for r in nearest_event(ev, anchors, "k", "t", "at", "before").collect())
    assert after == ["c", "d"]          # strictly after, both ties kept
    assert before == ["a"]              # strictly before: the join-day purchase is excluded
    incl = sorted(r.p for r in nearest_event(ev, anchors, "k", "t", "at", "after", inclusive=True).collect())
    assert incl == ["b"]


def test_extreme_rows_keeps_ties(spark):
    df = spark.createDataFrame([(1, D(2021, 1, 1), "a"), (1, D(2021, 1, 1), "b"), (1, D(2021, 1, 2), "c")],
                               "k int, t date, p string")
    assert sorted(r.p for r in extreme_rows(df, "k", "t", "first").collect()) == ["a", "b"]


def test_time_in_state_drops_open_intervals(spark):
    df = spark.createDataFrame([(D(2020, 1, 1), D(2020, 1, 31)), (D(2020, 2, 1), D(9999, 12, 31))],
                               "s date, e date")
    assert [r.days for r in time_in_state(df, "s", "e").collect()] == [30]


def test_running_balance_same_day_ties_share_value(spark):
    rows = [(1, D(2020, 1, 2), "deposit", 100), (1, D(2020, 1, 1), "purchase", 30),
            (1, D(2020, 1, 2), "withdrawal", 20), (2, D(2020, 1, 5), "deposit", 7)]
    df = spark.createDataFrame(rows, "customer_id int, txn_date date, txn_type string, txn_amount int")
    got = sorted((r.customer_id, r.txn_date, r.txn_type, r.running_balance) for r in running_balance(df).collect())
    assert got == [(1, D(2020, 1, 1), "purchase", -30), (1, D(2020, 1, 2), "deposit", 50),
                   (1, D(2020, 1, 2), "withdrawal", 50), (2, D(2020, 1, 5), "deposit", 7)]
    # property: the last balance equals the total signed amount
    total = df.select(F.sum(F.when(F.col("txn_type") == "deposit", F.col("txn_amount"))
                            .otherwise(-F.col("txn_amount")))).first()[0]
    assert max(g[3] for g in got if g[0] == 1) + 7 == total


def test_share_of_total_sums_to_100(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 5)], "k string, v long")
    out = share_of_total(df, "v", "pct")
    assert abs(sum(r.pct for r in out.collect()) - 100) < 0.02


def test_mean_distance_is_rounded_once(spark):
    from bizlens.operators.delivery import exact, mean_half_up
    df = spark.createDataFrame([(10.05, 1), (10.05, 1), (10.0, 1), (None, 5)], "km double, n int")
    assert df.agg(mean_half_up(exact(F.col("km")), F.col("n"), 1)).first()[0] == 10.0
    half = spark.createDataFrame([(13.6, 2), (13.7, 2)], "km double, n int")   # mean 13.65 rounds to 13.7
    assert half.agg(mean_half_up(exact(F.col("km")), F.col("n"), 1)).first()[0] == 13.7


def test_before_after_windows(spark):
    rows = [(20, 2020, 10), (23, 2020, 5), (24, 2020, 7), (27, 2020, 1), (28, 2020, 100), (24, 2019, 50)]
    df = spark.createDataFrame(rows, "week_number int, calendar_year int, sales long")
    r = before_after(df, 24, 4, year=2020).first()
    assert (r.before_change_sales, r.after_change_sales, r.difference) == (15, 8, -7)
    assert r.pct_variance == -46.67


def test_missing_values(spark):
    present = spark.createDataFrame([(1,), (2,), (4,)], "w int")
    assert [r[0] for r in missing_values(present, "w", 1, 5, "m").orderBy("m").collect()] == [3, 5]


def test_interval_join_borders_on_both_paths(spark):
    pts = spark.createDataFrame([(1, dt.datetime(2024, 1, 10, 12, 0)), (2, dt.datetime(2024, 1, 11, 0, 0)),
                                 (3, dt.datetime(2024, 1, 1, 0, 0))], "id int, ts timestamp_ntz")
    iv = spark.createDataFrame([("A", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 10, 12, 0))],
                               "name string, s timestamp_ntz, e timestamp_ntz")
    small = sorted((r.id, r.name) for r in interval_join(pts, iv, "ts", "s", "e", max_rows=9).collect())
    covered = sorted((r.id, r.name) for r in interval_join(pts, iv, "ts", "s", "e").collect())
    assert small == covered == [(1, "A"), (2, None), (3, "A")]


def test_null_share_and_gaps(spark):
    m = spark.createDataFrame([(1,), (None,), (2,), (3,)], "interest_id long")
    mp = spark.createDataFrame([(1,), (2,), (9,)], "id long")
    assert null_share(m, "interest_id").first()[0] == 25.0
    assert null_share(m.dropna(), "interest_id").first()[0] is None
    assert sorted(r.interest_id for r in reference_gap(m.dropna(), mp, "interest_id", "id").collect()) == [3]
    assert [r.id for r in reference_gap(mp, m, "id", "interest_id").collect()] == [9]


def test_drop_sparse(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 1), (2, 1)], "e int, p int")
    assert drop_sparse(df, "e", "p", 2).count() == 2
    assert total_by(df, "e", n=F.count("*")).count() == 2


def _history(spark):
    import random
    rnd = random.Random(7)
    rows = [(k, D(2020, 1, 1) + dt.timedelta(days=rnd.randrange(0, 6)), i, rnd.randrange(0, 5))
            for k in (1, 2) for i in range(40 if k == 1 else 3)]
    return spark.createDataFrame(rows, "k int, d date, seq int, v int")


def test_bucketed_lead_lag_equal_plain_window(spark):
    from pyspark.sql import Window
    from bizlens.operators.ordered import lead_lag
    df = _history(spark)
    w = Window.partitionBy("k").orderBy("d", "seq")
    want = df.select("k", "seq", F.lead("v").over(w).alias("nv"), F.lead("d").over(w).alias("nd"),
                     F.lag("v").over(w).alias("pv"))
    got_lead = lead_lag(df, "k", ["d", "seq"], {"v": "nv", "d": "nd"}, F.col("d"), "lead")
    got_lag = lead_lag(df, "k", ["d", "seq"], {"v": "pv"}, F.col("d"), "lag")
    got = got_lead.join(got_lag.select("k", "seq", "pv"), ["k", "seq"]).select("k", "seq", "nv", "nd", "pv")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_bucketed_row_number_and_rank_equal_plain_window(spark):
    from pyspark.sql import Window
    from bizlens.operators.ordered import rank_by, row_number
    df = _history(spark)
    w = Window.partitionBy("k").orderBy("d", "seq")
    want = sorted(map(tuple, df.select("k", "seq", F.row_number().over(w)).collect()))
    got = sorted(map(tuple, row_number(df, "k", ["d", "seq"], F.col("d"), "rn").select("k", "seq", "rn").collect()))
    assert got == want
    wr = Window.partitionBy("k").orderBy("d")
    want_r = sorted(map(tuple, df.select("k", "seq", F.rank().over(wr)).collect()))
    got_r = sorted(map(tuple, rank_by(df, ["k"], "d", "r").select("k", "seq", "r").collect()))
    assert got_r == want_r


def test_interval_join_open_ended(spark):
    pts = spark.createDataFrame([(1, dt.datetime(2024, 1, 10, 12, 0)), (2, dt.datetime(2023, 12, 1))],
                                "id int, ts timestamp_ntz")
    iv = spark.createDataFrame([("open", dt.datetime(2024, 1, 1), dt.datetime(9999, 12, 31)),
                                ("old", dt.datetime(1990, 1, 1), dt.datetime(1990, 2, 1))],
                               "name string, s timestamp_ntz, e timestamp_ntz")
    got = sorted((r.id, r.name) for r in interval_join(pts, iv, "ts", "s", "e").collect())
    assert got == [(1, "open"), (2, None)]


def test_reference_gap_not_in_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    right_null = spark.createDataFrame([(1,), (None,)], "k2 long")
    right = spark.createDataFrame([(1,)], "k2 long")
    assert reference_gap(left, right_null, "k", "k2", null_aware=True).count() == 0      # NULL in the subquery
    assert sorted(r.k for r in reference_gap(left, right, "k", "k2", null_aware=True).collect()) == [2]
    got = sorted((r.k is None, r.k) for r in reference_gap(left, right_null, "k", "k2").collect())
    assert got == [(False, 2), (True, None)]                                           # NOT EXISTS keeps NULL


def test_interval_join_forms_agree(spark):
    pts = spark.createDataFrame([(i, dt.datetime(2023, 1, 1) + dt.timedelta(days=37 * i, hours=i))
                                 for i in range(20)], "id int, ts timestamp_ntz")
    iv = spark.createDataFrame([("a", dt.datetime(2023, 2, 1), dt.datetime(2023, 9, 15, 12)),
                                ("b", dt.datetime(2023, 6, 1), dt.datetime(9999, 12, 31)),
                                ("c", dt.datetime(2024, 3, 3), dt.datetime(2024, 3, 4))],
                               "name string, s timestamp_ntz, e timestamp_ntz")
    want = sorted((r.id, r.name or "") for r in interval_join(pts, iv, "ts", "s", "e", max_rows=9).collect())
    assert sorted((r.id, r.name or "") for r in interval_join(pts, iv, "ts", "s", "e").collect()) == want


def test_percentiles_exact_and_approximate(spark):
    from bizlens.operators.temporal import approx_percentiles_by, percentiles_by
    df = spark.createDataFrame([("a", float(i)) for i in range(101)], "g string, v double")
    exact = percentiles_by(df, ["g"], "v", {"p50": 0.5, "p95": 0.95}).first()
    assert (exact.p50, exact.p95) == (50.0, 95.0)
    assert abs(approx_percentiles_by(df, ["g"], "v", {"p50": 0.5}).first().p50 - 50) <= 1


def test_distinct_counts_are_exact_unless_an_error_is_given(spark):
    from bizlens.operators.aggregate import distinct_count
    df = spark.range(10_000).select((F.col("id") % 7000).alias("v"))
    assert df.agg(distinct_count("v")).first()[0] == 7000
    assert abs(df.agg(distinct_count("v", 0.02)).first()[0] - 7000) < 700


def test_status_at_flags_events_by_anchor(spark):
    from bizlens.operators.temporal import status_at
    ev = spark.createDataFrame([(1, D(2021, 1, 6)), (1, D(2021, 1, 7)), (2, D(2021, 1, 9))], "k int, t date")
    anchors = spark.createDataFrame([(1, D(2021, 1, 7))], "k int, at date")
    got = sorted(tuple(r) for r in status_at(ev, anchors, "k", "t", "at").collect())
    assert got == [(1, D(2021, 1, 6), "N"), (1, D(2021, 1, 7), "Y"), (2, D(2021, 1, 9), "N")]
