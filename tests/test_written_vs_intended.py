"""As-written and intended forms differ exactly where the original statements
are wrong, on hand-written domain rows (a Domain whose tables are literals)."""

import datetime as dt

from bizlens.plans import bank, clickstream, diner, pizza, subscriptions
from bizlens.sources.domain import Domain

D = dt.date
T = dt.datetime


def literal_domain(spark, **tables):
    d = Domain(spark, "/nonexistent")
    for name, (schema, rows) in tables.items():
        d.__dict__[name] = spark.createDataFrame(rows, schema)  # pre-fills the cached properties
    return d


SALES = "customer_id long, order_date date, product_id long"
MENU = "product_id long, product_name string, price int"
MEMBERS = "customer_id long, join_date date"


def test_points_first_week_non_member_sushi(spark):
    d = literal_domain(
        spark,
        sales=(SALES, [(1, D(1998, 1, 10), 1), (2, D(1998, 1, 10), 1), (1, D(1998, 1, 20), 2)]),
        menu=(MENU, [(1, "sushi", 10), (2, "curry", 15)]),
        members=(MEMBERS, [(1, D(1998, 1, 18))]))
    written = dict(map(tuple, diner.points_first_week(d).collect()))
    intended = dict(map(tuple, diner.points_first_week_intended(d).collect()))
    assert written == {1: 200 + 300, 2: 100}      # non-member's sushi earns 10x as written
    assert intended == {1: 200 + 300, 2: 200}     # ... and 20x as intended


def test_member_status_and_ranking(spark):
    d = literal_domain(
        spark,
        sales=(SALES, [(1, D(2021, 1, 1), 1), (1, D(2021, 1, 7), 1), (1, D(2021, 1, 7), 2), (1, D(2021, 1, 9), 1),
                       (2, D(2021, 1, 9), 2)]),
        menu=(MENU, [(1, "sushi", 10), (2, "curry", 15)]),
        members=(MEMBERS, [(1, D(2021, 1, 7))]))
    rows = sorted((r.customer_id, r.order_date, r.product_name, r.member, r.ranking)
                  for r in diner.member_order_ranking(d).collect())
    assert rows == [(1, D(2021, 1, 1), "sushi", "N", None), (1, D(2021, 1, 7), "curry", "Y", 1),
                    (1, D(2021, 1, 7), "sushi", "Y", 1), (1, D(2021, 1, 9), "sushi", "Y", 3),
                    (2, D(2021, 1, 9), "curry", "N", None)]


CO = "order_id long, customer_id long, pizza_id long, exclusions string, extras string, order_time timestamp_ntz"
RO = ("order_id long, runner_id int, pickup_time string, distance string, duration string, "
      "cancellation string")


def test_unique_orders_and_delivery_report_minutes(spark):
    d = literal_domain(
        spark,
        customer_orders=(CO, [(1, 101, 1, "", "", T(2020, 1, 1, 18, 5, 2)), (2, 101, 1, "", "", T(2020, 1, 1, 19, 0, 0)),
                              (3, 102, 1, "4", "null", T(2020, 1, 2, 23, 0, 0))]),
        runner_orders=(RO, [(1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
                            (2, 1, "2020-01-01 20:10:54", "20km", "27 minutes", "null"),
                            (3, 2, "null", "null", "null", "Restaurant Cancellation")]),
        ratings=("order_id long, rating int", [(1, 5), (2, 4)]))
    assert pizza.unique_orders(d).first()[0] == 2
    assert pizza.unique_orders_intended(d).first()[0] == 3
    written = {r.order_id: r.time_order_pickup for r in pizza.delivery_report(d).collect()}
    intended = {r.order_id: r.time_order_pickup for r in pizza.delivery_report_intended(d).collect()}
    assert written == {1: 10, 2: 10}              # minute part only: 70 minutes shows as 10
    assert intended == {1: 10, 2: 70}
    assert sorted(r.runner_id for r in pizza.delivered_per_runner(d).collect()) == [1]


SUBS = "customer_id long, plan_id int, start_date date"


def test_days_to_annual_bins_border(spark):
    d = literal_domain(spark, subscriptions=(SUBS, [(1, 0, D(2020, 1, 1)), (1, 3, D(2020, 1, 31)),
                                                    (2, 0, D(2020, 1, 1)), (2, 3, D(2020, 1, 11))]))
    written = sorted(map(tuple, subscriptions.days_to_annual_bins(d).collect()))
    intended = sorted(map(tuple, subscriptions.days_to_annual_bins_intended(d).collect()))
    assert written == [("1 - 30 days ", 1), ("31 - 60 days ", 1)]   # a 30-day gap lands in 31-60
    assert intended == [("1 - 30 days ", 2)]


def test_days_to_annual_pairs_without_pair_join(spark):
    # customer 1 has two trials and two annual starts: 4 pairs, as a self join forms
    d = literal_domain(spark, subscriptions=(SUBS, [(1, 0, D(2020, 1, 1)), (1, 0, D(2020, 1, 5)),
                                                    (1, 3, D(2020, 2, 1)), (1, 3, D(2020, 3, 1)),
                                                    (2, 0, D(2020, 1, 1)), (2, 3, D(2020, 1, 2))]))
    pairs = [31, 27, 60, 56, 1]
    assert subscriptions.days_to_annual(d).first()[0] == round(sum(pairs) / len(pairs))


def test_churn_after_trial_forms(spark):
    d = literal_domain(spark, subscriptions=(SUBS, [(1, 0, D(2020, 1, 1)), (1, 4, D(2020, 1, 8)),
                                                    (2, 0, D(2020, 1, 1)), (2, 1, D(2020, 1, 8)),
                                                    (2, 4, D(2020, 2, 8)), (3, 4, D(2020, 1, 1)),
                                                    (3, 0, D(2020, 1, 2))]))
    # lag in plan order: customers 1 and 3 (plan order ignores dates); lead in date order: customer 1
    assert subscriptions.churn_after_trial(d).first().total_customers == 2
    assert subscriptions.churn_after_trial_next(d).first().total_customers == 1


TXN = "customer_id long, txn_date date, txn_type string, txn_amount int"


def test_growth_sign_with_negative_previous_balance(spark):
    d = literal_domain(spark, customer_transactions=(TXN, [
        (1, D(2020, 1, 5), "purchase", 100), (1, D(2020, 2, 5), "deposit", 50),   # -100 -> -50: +50 %
        (2, D(2020, 1, 5), "deposit", 100), (2, D(2020, 2, 5), "deposit", 1)]))   # +1 %
    assert bank.pct_growing_balance(d).first()[0] == 0.0          # -50 % as written
    assert bank.pct_growing_balance_intended(d).first()[0] == 50.0


EV = "visit_id string, cookie_id string, page_id int, event_type int, event_time timestamp_ntz, sequence_number int"
PAGES = "page_id int, page_name string, product_category string, product_id int"


def test_funnel_purchase_multiplicity(spark):
    d = literal_domain(
        spark,
        click_events=(EV, [("v1", "c", 3, 1, T(2024, 1, 1, 1), 1), ("v1", "c", 3, 2, T(2024, 1, 1, 2), 2),
                           ("v1", "c", 13, 3, T(2024, 1, 1, 3), 3), ("v1", "c", 13, 3, T(2024, 1, 1, 4), 4),
                           ("v2", "c", 3, 2, T(2024, 1, 2, 1), 1)]),
        page_hierarchy=(PAGES, [(3, "Anchovy", "Fish", 1), (13, "Confirmation", None, None)]))
    w = clickstream.product_funnel(d).first()
    i = clickstream.product_funnel_intended(d).first()
    # as written the v1 cart add meets both purchase events: counted twice
    assert (w.product_viewed, w.product_addedtocart, w.product_purchased, w.product_abandoned) == (1, 3, 2, 1)
    assert (i.product_viewed, i.product_addedtocart, i.product_purchased, i.product_abandoned) == (1, 2, 1, 1)


def test_demographic_share_matches_unknown_case_insensitively(spark):
    from bizlens.plans import retail
    ws = ("week_date string, region string, platform string, segment string, customer_type string, "
          "transactions int, sales long")
    d = literal_domain(spark, weekly_sales=(ws, [("2020-06-15", "ASIA", "Retail", "C1", "New", 10, 300),
                                                 ("2020-06-15", "ASIA", "Retail", "null", "New", 5, 100)]))
    r = retail.demographic_share_by_year(d).first()
    assert (r.couples_percentage, r.families_percentage, r.unknown_percentage) == (75.0, None, 25.0)
