"""Properties of query results on the smallest input."""

from pyspark.sql import functions as F

from bizlens.operators.coverage import reference_gap
from bizlens.plans import spark_queries
from bizlens.sources.domain import Domain

Q = spark_queries()


def test_platform_shares_sum_to_100(spark, small_dir):
    for r in Q["platform_share_by_month"](spark, small_dir).collect():
        parts = [v for v in (r.retail_sales_percentage, r.shopify_sales_percentage) if v is not None]
        assert abs(sum(parts) - 100) <= 0.011


def test_last_running_balance_is_the_signed_total(spark, small_dir):
    rb = Q["running_balance"](spark, small_dir)
    last = rb.groupBy("customer_id").agg(F.max_by("running_balance", "txn_date").alias("last"))
    t = Domain(spark, small_dir).customer_transactions
    total = t.groupBy("customer_id").agg(F.sum(F.when(F.col("txn_type") == "deposit", F.col("txn_amount"))
                                              .otherwise(-F.col("txn_amount"))).alias("total"))
    assert last.join(total, "customer_id").filter(F.col("last") != F.col("total")).count() == 0


def test_funnel_identity(spark, small_dir):
    for name in ("product_funnel", "product_funnel_intended", "category_funnel", "category_funnel_intended"):
        bad = Q[name](spark, small_dir).filter(
            F.col("product_addedtocart") != F.col("product_purchased") + F.col("product_abandoned"))
        assert bad.count() == 0, name


def test_as_of_rows_are_on_the_right_side(spark, small_dir):
    m = Domain(spark, small_dir).members
    after = Q["first_after_join"](spark, small_dir).join(m, "customer_id")
    before = Q["last_before_join"](spark, small_dir).join(m, "customer_id")
    assert after.count() > 0 and after.filter(F.col("order_date") <= F.col("join_date")).count() == 0
    assert before.count() > 0 and before.filter(F.col("order_date") >= F.col("join_date")).count() == 0


def test_anti_plus_semi_is_every_keyed_row(spark, small_dir):
    d = Domain(spark, small_dir)
    metrics = d.interest_metrics.filter(F.col("interest_id").isNotNull())
    anti = reference_gap(metrics, d.interest_map, "interest_id", "id").count()
    semi = metrics.join(d.interest_map, F.col("interest_id") == F.col("id"), "left_semi").count()
    assert anti > 0 and semi > 0 and anti + semi == metrics.count()


def test_week_numbers_and_bins_cover_every_row(spark, small_dir):
    cws = Q["clean_weekly_sales"](spark, small_dir)
    assert cws.filter(F.col("week_number").isNull() | ~F.col("week_number").between(0, 53)).count() == 0
    bins = Q["days_to_annual_bins_intended"](spark, small_dir).agg(F.sum("total")).first()[0]
    s = Domain(spark, small_dir).subscriptions
    both = s.groupBy("customer_id").agg(F.max((F.col("plan_id") == 0).cast("int")).alias("t"),
                                        F.max((F.col("plan_id") == 3).cast("int")).alias("a"))
    assert bins > 0 and bins == both.filter((F.col("t") == 1) & (F.col("a") == 1)).count()
