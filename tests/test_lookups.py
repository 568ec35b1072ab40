"""Lookup tables of any size: toppings, pages and campaigns beyond what one value or a broadcast would take."""

import datetime as dt
import random

from pyspark.sql import functions as F

from bizlens.operators.toppings import ingredient_list, item_label
from bizlens.operators.visits import funnel, visit_summary


def test_a_hundred_thousand_toppings(spark):
    tops = spark.range(1, 100_001).select(F.col("id").cast("int").alias("topping_id"), F.concat(F.lit("T"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("topping_name"))
    items = spark.createDataFrame([(1, 1, "7, 99999", "5,100000,5"), (2, 1, None, ""), (3, 2, "null", "77777, 123456789"), (4, 9, None, None)],
                                  "order_id int, pizza_id int, exclusions string, extras string").withColumn("pizza_name", F.lit("P"))
    recipes = spark.createDataFrame([(1, "99999, 5, 42"), (2, "100000"), (3, "1")], "pizza_id int, toppings string")
    got = {r.order_id: r.ingredient_list for r in ingredient_list(items, recipes, tops).collect()}
    assert got == {1: "P: 3xT000005, T000042, T100000", 2: "P: T000005, T000042, T099999", 3: "P: T077777, T100000"}
    labels = {r.order_id: r.order_item for r in item_label(items, tops).collect()}
    assert labels == {1: "P - Exclude T000007, T099999 - Extra T000005, T100000, T000005", 2: "P", 3: "P - Extra T077777", 4: "P"}


def test_many_pages_and_campaigns(spark):
    rng = random.Random(3)
    at = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randint(0, 500_000))
    pages = spark.range(1, 12_001).select(F.col("id").cast("int").alias("page_id"), F.concat(F.lit("p"), "id").alias("page_name"),
                                          F.when(F.col("id") % 2 == 0, F.col("id")).alias("product_id"))
    spans = [sorted((at(), at())) for _ in range(1500)]
    spans = [(f"c{k}", a, a + dt.timedelta(minutes=rng.randint(0, 900))) for k, (a, _) in enumerate(spans)]
    campaigns = spark.createDataFrame(spans, "campaign_name string, start_date timestamp_ntz, end_date timestamp_ntz")
    users = spark.createDataFrame([(k, f"k{k}") for k in range(20)], "user_id int, cookie_id string")
    events = spark.createDataFrame([(f"v{v}", f"k{v % 20}", rng.randint(1, 12_000), rng.randint(1, 5), at(), s) for v in range(60) for s in range(6)],
                                   "visit_id string, cookie_id string, page_id int, event_type int, event_time timestamp_ntz, sequence_number int")
    for per_event in (False, True):
        covered = visit_summary(events, users, pages, campaigns, campaign_per_event=per_event)
        sent = visit_summary(events, users, pages, campaigns, campaign_per_event=per_event, max_campaigns=2000)
        rows = sorted(map(tuple, covered.collect()), key=repr)
        assert rows == sorted(map(tuple, sent.collect()), key=repr) and len(rows) >= 60
    views = funnel(events, pages, ["page_name"])
    data = events.collect()
    assert {r.page_name: r.product_viewed for r in views.collect()} == {
        f"p{p}": sum(e.page_id == p and e.event_type == 1 for e in data) for p in {e.page_id for e in data} if p % 2 == 0}
