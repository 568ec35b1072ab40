"""Range partitions by sampled splits, running values over them, as-of joins with
many anchors and percentiles by rank selection."""

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bizlens.operators.ordered import lead_lag, parts, row_number, scan
from bizlens.operators.temporal import nearest_event, percentiles_by


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_parts_follow_the_order_and_split_a_hot_key(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).alias("k"), F.xxhash64("id").alias("t"), "id")
    got = parts(df, ["k", "t"], n=16).select("k", "t", "__b").orderBy("k", "t").collect()
    numbers = [r["__b"] for r in got]
    assert numbers == sorted(numbers) and set(numbers) == set(range(16))
    sizes = [numbers.count(b) for b in range(16)]
    assert max(sizes) < 3 * min(sizes)
    hot = {r["__b"] for r in got if r["k"] == 7}
    assert len(hot) > 8  # two thirds of the rows are one key
    assert [r["__b"] for r in parts(df, ["k", "t"], n=16).select("k", "t", "__b").orderBy("k", "t").collect()] == numbers


def test_parts_of_few_equal_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, None), (2, 5)], "k int, t int")
    got = {(r.k, r.t): r["__b"] for r in parts(df, ["k", "t"]).collect()}
    assert got[None, 1] <= got[2, None] <= got[2, 5]
    assert parts(df.limit(0), ["k", "t"]).count() == 0


@pytest.mark.parametrize("backward", [False, True])
@pytest.mark.parametrize("exclusive", [False, True])
def test_scan_equals_the_window(spark, backward, exclusive):
    rng = random.Random(backward * 2 + exclusive)
    data = [(rng.choice([1, 1, 1, 2, None]), rng.choice([None, *range(40)]), i, rng.choice([None, *range(-5, 9)])) for i in range(900)]
    df = spark.createDataFrame(data, "k int, t int, id int, v int")
    way = F.desc if backward else F.asc
    w = Window.partitionBy("k").orderBy(way("t"), way("id")).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    want = df.select("id", F.sum("v").over(w).alias("s"), F.count("v").over(w).alias("n"), F.min("v").over(w).alias("lo"), F.max("v").over(w).alias("hi"),
                     F.last("v", ignorenulls=True).over(w).alias("p"))
    got = scan(df, ["k"], ["t", "id"], {"s": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "p": ("last", "v")}, backward=backward, exclusive=exclusive)
    cols = ("id", "s", "n", "lo", "hi", "p")
    assert rows(got, *cols) == rows(want, *cols)


def test_scan_of_the_whole_table(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("v"))
    got = {r.id: r.s for r in scan(df, [], ["id"], {"s": ("sum", "v")}).collect()}
    assert got == {i: sum(k % 7 for k in range(i + 1)) for i in range(500)}


def test_lead_and_row_number_without_a_bucket(spark):
    data = [(k, t, i) for i, (k, t) in enumerate((random.Random(5).choices([1, None, 3], [8, 1, 1])[0], i // 3) for i in range(300))]
    df = spark.createDataFrame(data, "k int, t int, id int")
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.withColumns({"nxt": F.lead("id").over(w), "rn": F.row_number().over(w), "prev": F.lag("id").over(w)})
    got = row_number(lead_lag(lead_lag(df, "k", ["t", "id"], {"id": "nxt"}), "k", ["t", "id"], {"id": "prev"}, direction="lag"), "k", ["t", "id"], out="rn")
    assert rows(got, "id", "nxt", "rn", "prev") == rows(want, "id", "nxt", "rn", "prev")


def near(events, anchors, after, inclusive):
    out = []
    for k, at in {a for a in anchors if None not in a}:
        ok = [t for e, t, _ in events if e == k and t is not None and ((t > at if after else t < at) or (inclusive and t == at))]
        if ok:
            best = min(ok) if after else max(ok)
            out += [(k, at, t, i) for e, t, i in events if e == k and t == best]
    return sorted(out, key=repr)


@pytest.mark.parametrize("after", [True, False])
@pytest.mark.parametrize("inclusive", [True, False])
def test_nearest_event_of_many_anchors(spark, after, inclusive):
    rng = random.Random(after * 2 + inclusive)
    events = [(rng.choice([1, 1, 1, 2, None]), rng.choice([None, *range(60)]), i) for i in range(400)]
    anchors = [(rng.choice([1, 1, 2, 3, None]), rng.choice([None, *range(-3, 65)])) for _ in range(150)]
    got = nearest_event(spark.createDataFrame(events, "k int, t int, id int"), spark.createDataFrame(anchors, "k int, at int"), "k", "t", "at", "after" if after else "before", inclusive)
    assert rows(got, "k", "at", "t", "id") == near(events, anchors, after, inclusive)


def test_nearest_event_forms_no_pairs(spark):
    """100,000 events and as many anchors of one key: a pair join would make 10^10 rows."""
    events = spark.range(100_000).select(F.lit(1).alias("k"), (F.col("id") * 2).alias("t"))
    anchors = spark.range(100_000).select(F.lit(1).alias("k"), (F.col("id") * 2 + 1).alias("at"))
    got = nearest_event(events, anchors, "k", "t", "at", "before").agg(F.count("*").alias("n"), F.max(F.col("at") - F.col("t")).alias("d"), F.min(F.col("at") - F.col("t")).alias("e")).first()
    assert tuple(got) == (100_000, 1, 1)


def test_percentiles_by_rank_selection(spark):
    rng = random.Random(9)
    data = [(rng.choice(["hot", "hot", "hot", "b", None]), rng.choice([None, rng.randint(-50, 50), rng.randint(0, 10**9)])) for _ in range(3000)] + [("one", 5), ("none", None), ("two", 1), ("two", 2)]
    df = spark.createDataFrame(data, "g string, v long")
    ps = {"p0": 0.0, "p20": 0.2, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.g: tuple(r[p] for p in ps) for r in percentiles_by(df, ["g"], "v", ps).collect()}
    spark_own = {r.g: tuple(r[p] for p in ps) for r in df.groupBy("g").agg(*[F.percentile("v", p).alias(n) for n, p in ps.items()]).collect()}
    assert set(got) == set(spark_own) and got["none"] == (None,) * 5
    for g, want in spark_own.items():
        assert got[g] == want if want[0] is None else got[g] == pytest.approx(want, rel=1e-12)
    for width in (7, 1e6):
        assert {r.g: tuple(r[p] for p in ps) for r in percentiles_by(df, ["g"], "v", ps, width=width).collect()} == got
    whole = percentiles_by(df, [], "v", {"m": 0.5}).first().m
    assert whole == statistics.median(v for _, v in data if v is not None)
