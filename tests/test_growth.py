"""Steps whose memory or time grew faster than their rows, on rows of the tests' own."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bizlens.operators.joins import dyadic_cover
from bizlens.operators.keys import join_hot, join_null_safe, key_counts
from bizlens.operators.ledger import trailing_day_balances
from bizlens.operators.toppings import ingredient_list, item_label
from bizlens.plans import spark_queries
from bizlens.sources.driver import SCHEMAS

D = dt.date
T = dt.datetime


def tables(spark, folder, **rows):
    """An input folder of the given tables; columns that are not given are NULL."""
    for name, given in rows.items():
        schema = SCHEMAS[name]
        cols = [c.strip().split(" ")[0] for c in schema.split(",")]
        spark.createDataFrame([tuple(r.get(c) for c in cols) for r in given], schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def plan_lines(df):
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def depth(line):
    return max(line.find("+- "), line.find(":- "))


def subtree(lines, i):
    """The lines under the ``i``-th."""
    end = next((j for j in range(i + 1, len(lines)) if depth(lines[j]) <= depth(lines[i])), len(lines))
    return lines[i + 1 : end]


def test_opened_recipes_are_not_sent_everywhere(spark, tmp_path):
    parts = [{"p_partkey": k, "p_size": k % 3} for k in range(1, 40)]
    orders = [{"o_orderkey": k, "o_custkey": k % 7, "o_orderdate": T(1995, 1, 1)} for k in range(60)]
    lines = [{"l_orderkey": k % 60, "l_partkey": k % 45, "l_suppkey": k, "l_linenumber": k % 7} for k in range(300)]
    folder = tables(spark, tmp_path, part=parts, orders=orders, lineitem=lines)
    df = spark_queries()["ingredient_quantities"](spark, folder)
    found = plan_lines(df)
    for i, line in enumerate(found):
        assert "BroadcastExchange" not in line or not any("Generate" in x for x in subtree(found, i)), "\n".join(found)
    delivered = {o["o_orderkey"] for o in orders if (o["o_orderkey"] * 7 + o["o_custkey"]) % 10 >= 2}
    size = {p["p_partkey"]: p["p_size"] for p in parts}
    used = Counter(t for x in lines if x["l_orderkey"] in delivered and x["l_partkey"] in size
                   for t in range(1, 13) if (x["l_partkey"] + t * (size[x["l_partkey"]] % 2 + 1)) % 3)
    assert sorted(r.total_quantity for r in df.collect()) == sorted(used.values())


@pytest.fixture
def plain_joins(spark):
    """Shuffled joins as planned, as for tables beyond any broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in zip(keys, ("-1", "false")):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_items_of_one_list_are_not_one_task(spark, plain_joins):
    tops = spark.createDataFrame([(1, "Bacon"), (2, "Cheese")], "topping_id int, topping_name string")
    items = spark.range(4000).select(F.col("id").alias("order_id"), F.lit(7).alias("pizza_id"), F.lit("Meat").alias("pizza_name"), F.when(F.col("id") < 3900, "2, 1").alias("exclusions"),
                                     F.when(F.col("id") % 2 == 0, "1").otherwise("null").alias("extras"))
    labels = item_label(items, tops)
    lists = ingredient_list(items, spark.createDataFrame([(7, "1, 2")], "pizza_id int, toppings string"), tops)
    for made in (labels, lists):
        in_task = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(in_task) == 4000 and max(in_task) < 2000, in_task
    assert Counter(r.order_item for r in labels.collect()) == {
        "Meat - Exclude Cheese, Bacon - Extra Bacon": 1950, "Meat - Exclude Cheese, Bacon": 1950, "Meat - Extra Bacon": 50, "Meat": 50}
    assert Counter(r.ingredient_list for r in lists.collect()) == {
        "Meat: Bacon": 1950, "Meat: ": 1950, "Meat: 2xBacon, Cheese": 50, "Meat: Bacon, Cheese": 50}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_hot_equals_a_null_safe_join(spark, plain_joins, how):
    left = spark.range(3000).select(F.col("id").alias("n"), F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.when(F.col("id") % 2 == 0, F.col("id").cast("string"))).alias("a"),
                                    F.when(F.col("id") % 4 > 0, 5).alias("b"))
    left = left.unionAll(left.limit(100))
    right = left.filter("n % 5 > 0").select("a", "b").distinct().withColumn("v", F.concat_ws("/", "a", "b"))
    got = join_hot(left, right, ["a", "b"], key_counts(left, ["a", "b"]), how)
    want = join_null_safe(left, right, ["a", "b"], how)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_trailing_balances_are_made_month_by_month(spark):
    rows = [(1, D(2023, 1, 5), "deposit", None), (1, D(2023, 3, 3), "deposit", 8), (1, D(2023, 3, 10), "purchase", 3), (1, D(2023, 3, 17), "deposit", 2), (1, D(2023, 5, 31), "deposit", 1),
            (2, D(2023, 2, 28), "purchase", 4), (2, D(2023, 2, 28), "deposit", 9), (None, D(2023, 4, 30), "deposit", 6)]
    held = trailing_day_balances(spark.createDataFrame(rows, "customer_id int, txn_date date, txn_type string, txn_amount int"), 7)
    lines = plan_lines(held)
    opened = next(i for i, x in enumerate(lines) if "Generate" in x)
    assert not any("Aggregate" in x for x in lines[:opened]), "months are gathered again"
    assert {(r.customer_id, r.month.month): r.day_balances for r in held.collect()} == {
        (1, 1): None, (1, 2): None, (1, 3): 49, (1, 4): 49, (1, 5): 50, (2, 2): 5, (2, 3): 35, (2, 4): 35, (2, 5): 35, (None, 4): 6, (None, 5): 42}


def test_stints_are_counted_before_they_meet_months(spark, tmp_path):
    day = lambda k: T(1995, 1, 1) + dt.timedelta(days=(k * 37) % 500)
    orders = [{"o_orderkey": k, "o_custkey": k % 9, "o_orderstatus": "O", "o_totalprice": 1000.0, "o_orderdate": day(k)} for k in range(90)]
    orders += [{"o_orderkey": 200 + k, "o_custkey": 3, "o_orderstatus": "O", "o_totalprice": 1.0, "o_orderdate": T(1995, m, d)} for k, (m, d) in enumerate([(1, 31), (2, 28), (2, 28), (3, 1)])]
    customers = [{"c_custkey": k, "c_nationkey": k % 4} for k in range(8)]
    nations = [{"n_nationkey": k, "n_regionkey": k % 2} for k in range(4)]
    folder = tables(spark, tmp_path, orders=orders, customer=customers, nation=nations)
    df = spark_queries()["stints_open_at_month_end"](spark, folder)
    lines = plan_lines(df)
    covers = [i for i, x in enumerate(lines) if "Generate explode(filter(flatten" in x]
    assert covers
    for i in covers:  # what is cut into blocks is an aggregate
        assert "Aggregate" in next(x for x in lines[i + 1 :] if not any(w in x for w in ("Filter", "Project", "AQEShuffleRead", "Exchange"))), "\n".join(lines)
    ends = {(o["o_orderdate"].replace(day=28) + dt.timedelta(days=4)).replace(day=1).date() - dt.timedelta(days=1) for o in orders}
    want = Counter()
    for c in customers:
        own = sorted((o["o_orderdate"], o["o_orderkey"]) for o in orders if o["o_custkey"] == c["c_custkey"])
        for (a, _), b in zip(own, [x for x, _ in own[1:]] + [T(9999, 12, 31)]):
            want.update((e, c["c_nationkey"] % 4 % 2 + 1) for e in ends if a.date() <= e <= b.date())
    assert {(r.month_end, r.region_id): r.open_stints for r in df.collect()} == want


def test_cover_of_the_lengths_that_are_needed(spark):
    spans = [(a, a + n) for a in (-70, -1, 0, 5, 1023) for n in (0, 1, 6, 63, 127)]
    df = spark.createDataFrame(spans, "a long, b long")
    both = df.select(dyadic_cover(F.col("a"), F.col("b")).alias("every"), dyadic_cover(F.col("a"), F.col("b"), F.lit(8)).alias("some"))
    assert both.filter("every = some").count() == len(spans)
