"""NULL keys, order values and buckets: nothing is lost, results equal plain windows."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bizlens.operators.aggregate import share_of_total, weighted_sum
from bizlens.operators.coverage import cumulative_share, sparse_rows
from bizlens.operators.joins import checked_broadcast, interval_join
from bizlens.operators.ledger import balance_stats, running_balance
from bizlens.operators.ordered import lead_lag, rank_by, row_number
from bizlens.operators.temporal import nearest_event

D = dt.date
ROWS = [(1, D(2020, 1, 1), 1, 10), (1, None, 2, 20), (1, D(2020, 1, 2), 3, 30), (None, D(2020, 1, 1), 4, 40), (None, None, 5, 50),
        (None, D(2020, 1, 1), 6, 60), (2, None, 7, 70)]


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame(ROWS, "k int, d date, seq int, v int")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("direction, fn", [("lead", F.lead), ("lag", F.lag)])
def test_lead_lag(history, direction, fn):
    w = Window.partitionBy("k").orderBy("d", "seq")
    got = lead_lag(history, "k", ["d", "seq"], {"v": "o", "d": "od"}, F.col("d"), direction)
    assert rows(got.select("seq", "o", "od")) == rows(history.select("seq", fn("v").over(w), fn("d").over(w)))


def test_row_number_and_rank(history):
    w = Window.partitionBy("k").orderBy("d", "seq")
    assert rows(row_number(history, "k", ["d", "seq"], F.col("d"), "n").select("seq", "n")) == rows(history.select("seq", F.row_number().over(w)))
    assert rows(rank_by(history, ["k"], "d", "r").select("seq", "r")) == rows(
        history.select("seq", F.rank().over(Window.partitionBy("k").orderBy("d")).cast("bigint")))


def test_balances_and_shares(spark):
    t = spark.createDataFrame([(1, D(2020, 1, 1), "deposit", 5), (None, D(2020, 1, 1), "deposit", 7), (None, None, "purchase", 2), (1, None, "deposit", 1)],
                              "customer_id int, txn_date date, txn_type string, txn_amount int")
    w = Window.partitionBy("customer_id").orderBy("txn_date")
    signed = F.when(F.col("txn_type") == "deposit", F.col("txn_amount")).otherwise(-F.col("txn_amount"))
    want = t.withColumn("running_balance", F.sum(signed).over(w))
    assert rows(running_balance(t).select(*want.columns)) == rows(want)
    stats = want.groupBy("customer_id").agg(F.avg("running_balance"), F.min("running_balance"), F.max("running_balance"))
    assert rows(balance_stats(t)) == rows(stats)
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 5)], "g string, v int")
    assert sorted(r.p for r in share_of_total(df, "v", "p", within=["g"]).collect()) == [25.0, 75.0, 100.0]


def test_interval_join_kinds_on_both_paths(spark):
    points = spark.createDataFrame([(1, dt.datetime(2024, 1, 5)), (2, None), (3, dt.datetime(2025, 1, 1))], "id int, ts timestamp_ntz")
    spans = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)), ("b", dt.datetime(2024, 1, 5), dt.datetime(9999, 1, 1)),
                                   ("none", dt.datetime(1990, 1, 1), dt.datetime(1990, 2, 1)), ("open", None, dt.datetime(2024, 2, 1))],
                                  "name string, s timestamp_ntz, e timestamp_ntz")
    for how, want in (("inner", [(1, "a"), (1, "b"), (3, "b")]), ("left", [(1, "a"), (1, "b"), (2, None), (3, "b")])):
        for small in (None, 10):
            assert rows(interval_join(points, spans, "ts", "s", "e", how, max_rows=small).select("id", "name")) == want
    for how in ("right", "full", "left_anti"):
        with pytest.raises(ValueError):
            interval_join(points, spans, "ts", "s", "e", how)
    with pytest.raises(Exception, match="more than 3 rows"):
        interval_join(points, spans, "ts", "s", "e", max_rows=3).collect()
    assert checked_broadcast(spans, 4).count() == 4


def test_nearest_event_of_several_anchors(spark):
    ev = spark.createDataFrame([(1, D(2021, 1, d)) for d in (2, 5, 9)] + [(None, D(2021, 1, 3)), (1, None)], "k int, t date")
    anchors = spark.createDataFrame([(1, D(2021, 1, 1)), (1, D(2021, 1, 6)), (1, D(2021, 1, 6)), (None, D(2021, 1, 1))], "k int, at date")
    assert rows(nearest_event(ev, anchors, "k", "t", "at", "after").select("at", "t")) == [(D(2021, 1, 1), D(2021, 1, 2)), (D(2021, 1, 6), D(2021, 1, 9))]
    assert rows(nearest_event(ev, anchors, "k", "t", "at", "before").select("at", "t")) == [(D(2021, 1, 6), D(2021, 1, 5))]


def test_cumulative_share_equals_one_window(spark):
    counts = spark.createDataFrame([(n, n % 7 + 1) for n in [0, 1, 2, 3, 15, 16, 17, 900, 1000, 10**6]] + [(None, 2)], "n long, c long")
    w = Window.orderBy(F.desc("n"))
    want = counts.withColumn("p", F.round(100 * F.sum("c").over(w) / F.sum("c").over(Window.partitionBy()), 2))
    assert rows(cumulative_share(counts, "n", "c", "p").select("n", "c", "p")) == rows(want)


def test_sparse_rows_and_weights(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 1), (2, None), (None, 1)], "e int, m int")
    assert sparse_rows(df, "e", "m", 2, "n").first()[0] == 3
    items = spark.createDataFrame([("a", 2, True), ("a", 3, None), ("b", 5, False)], "k string, v int, twice boolean")
    assert rows(weighted_sum(items, "k", F.col("v"), [(F.col("twice"), 20)], 10, "p")) == [("a", 70), ("b", 50)]
