"""The case-study operators on literal rows."""

import datetime as dt

from pyspark.sql import functions as F

from bizlens.operators.delivery import delivery_metrics
from bizlens.operators.ledger import allocation, balance_growth, closing_balances, previous_balances, trailing_day_balances
from bizlens.operators.toppings import ingredient_list, ingredient_usage, item_label
from bizlens.operators.visits import funnel, visit_summary

D, T = dt.date, dt.datetime


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def txns(spark, data):
    return spark.createDataFrame(data, "customer_id int, txn_date date, txn_type string, txn_amount int")


def test_balances_are_carried_over_a_year_end(spark):
    t = txns(spark, [(1, D(2020, 11, 30), "deposit", 10), (1, D(2021, 2, 1), "purchase", 4), (2, D(2021, 1, 5), "purchase", 3)])
    b = closing_balances(t)
    assert rows(b) == [(1, D(2020, 11, 1), 10, 10), (1, D(2020, 12, 1), 0, 10), (1, D(2021, 1, 1), 0, 10), (1, D(2021, 2, 1), -4, 6),
                       (2, D(2021, 1, 1), -3, -3), (2, D(2021, 2, 1), 0, -3)]
    total = allocation(previous_balances(t), "month", F.col("previous_balance"), "total")
    assert rows(total) == [(D(2020, 11, 1), 0), (D(2020, 12, 1), 10), (D(2021, 1, 1), 10), (D(2021, 2, 1), 10)]
    grown = {(r.customer_id, r.month): r.pct_increase for r in balance_growth(b).collect()}
    assert grown[1, D(2020, 11, 1)] is None and grown[1, D(2020, 12, 1)] == 0 and grown[1, D(2021, 2, 1)] == -40


def test_trailing_balances_equal_a_sum_over_days(spark):
    data = [(1, D(2020, 1, 30), "deposit", 7), (1, D(2020, 2, 10), "purchase", 3), (1, D(2020, 2, 29), "deposit", 5), (1, D(2020, 5, 2), "deposit", 1),
            (2, D(2020, 1, 31), "purchase", 2)]
    got = {(r.customer_id, r.month): r.day_balances for r in trailing_day_balances(txns(spark, data)).collect()}
    for (k, month), total in got.items():
        end = (month.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        want = sum((a if kind == "deposit" else -a) for back in range(30) for c, d, kind, a in data if c == k and d <= end - dt.timedelta(days=back))
        assert total == want, (k, month)
    assert len(got) == 10


TOPPINGS = [(1, "Bacon"), (2, "cheese"), (13, "Anchovies")]


def test_toppings_come_from_their_table(spark):
    tops = spark.createDataFrame(TOPPINGS, "topping_id int, topping_name string")
    recipes = spark.createDataFrame([(7, "2, 1, 13"), (8, "99")], "pizza_id int, toppings string")
    items = spark.createDataFrame([(1, 7, "Meat", None, "13, 1"), (2, 7, "Meat", "1", "null"), (3, 8, "Odd", "", "13, 55")],
                                  "order_id int, pizza_id int, pizza_name string, exclusions string, extras string")
    assert rows(ingredient_list(items, recipes, tops).select("order_id", "ingredient_list")) == [
        (1, "Meat: 2xAnchovies, 2xBacon, cheese"), (2, "Meat: Anchovies, cheese"), (3, "Odd: Anchovies")]
    assert rows(item_label(items, tops).select("order_item")) == [("Meat - Exclude Bacon",), ("Meat - Extra Anchovies, Bacon",), ("Odd - Extra Anchovies",)]
    assert rows(ingredient_usage(items, recipes, tops)) == [("Anchovies", 4), ("Bacon", 2), ("cheese", 2)]


def test_delivery_metrics(spark):
    items = spark.createDataFrame([(1, 5, T(2020, 1, 1, 10, 0))] * 2 + [(2, 5, T(2020, 1, 1, 11, 0)), (3, 6, T(2020, 1, 1, 12, 0))],
                                  "order_id int, customer_id int, order_time timestamp_ntz")
    d = spark.createDataFrame([(1, 9, "2020-01-01 10:10:30", "20.25km", "30 mins", ""), (2, 9, "null", "null", "null", "Customer Cancellation"),
                               (3, 9, "2020-01-01 12:05", "10 km", "0", None)],
                              "order_id int, runner_id int, pickup_time string, distance string, duration string, cancellation string")
    got = rows(delivery_metrics(items, d).select("order_id", "n", "to_pickup", "km", "minutes", "speed_kmh", "delivered"))
    assert got == [(1, 2, 630, 20.25, 30.0, 40.5, True), (2, 1, None, None, None, None, False), (3, 1, 300, 10.0, 0.0, None, True)]


def clicks(spark):
    ev = [("v1", "c1", 3, 1, T(2024, 1, 1, 10, 0), 1), ("v1", "c1", 3, 2, T(2024, 1, 1, 10, 1), 2), ("v1", "c2", 4, 2, T(2024, 1, 1, 10, 2), 3),
          ("v1", "c1", 9, 3, T(2024, 1, 2, 10, 3), 4), ("v1", "c1", 9, 3, T(2024, 1, 2, 10, 4), 5), ("v2", "c1", 3, 2, T(2024, 1, 5, 0, 0), 1)]
    events = spark.createDataFrame(ev, "visit_id string, cookie_id string, page_id int, event_type int, event_time timestamp_ntz, sequence_number int")
    pages = spark.createDataFrame([(3, "Crab", 1), (4, "Tuna", 2), (9, "Done", None)], "page_id int, page_name string, product_id int")
    users = spark.createDataFrame([(1, "c1"), (1, "c2")], "user_id int, cookie_id string")
    offers = spark.createDataFrame([("new", T(2024, 1, 1), T(2024, 1, 1, 23, 0))], "campaign_name string, start_date timestamp_ntz, end_date timestamp_ntz")
    return events, pages, users, offers


def test_funnel(spark):
    events, pages, _, _ = clicks(spark)
    assert rows(funnel(events, pages, ["page_name"])) == [("Crab", 1, 2, 1, 1), ("Tuna", 0, 1, 1, 0)]
    assert rows(funnel(events, pages, ["page_name"], distinct_purchases=False)) == [("Crab", 1, 3, 2, 1), ("Tuna", 0, 2, 2, 0)]


def test_visit_summary_joins_a_users_cookies(spark):
    events, pages, users, offers = clicks(spark)
    cols = ["visit_id", "page_views", "cart_adds", "purchase", "campaign_name", "cart_products"]
    assert rows(visit_summary(events, users, pages, offers).select(*cols)) == [("v1", 1, 2, 1, "new", "Crab, Tuna"), ("v2", 0, 1, 0, None, "Crab")]
    per_event = visit_summary(events, users, pages, offers, campaign_per_event=True)
    assert rows(per_event.select(*cols)) == [("v1", 0, 0, 2, None, None), ("v1", 1, 2, 0, "new", "Crab, Tuna"), ("v2", 0, 1, 0, None, "Crab")]
