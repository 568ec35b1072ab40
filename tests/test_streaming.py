"""Streaming forms agree with the batch queries once all input is processed."""

import tempfile

from pyspark.sql import functions as F

from bizlens.plans import spark_queries
from bizlens.sources.domain import Domain
from bizlens.sources.fixed import lookup
from bizlens.streaming.ledger import live_balances, orders_stream
from bizlens.streaming.visits import events_stream, visit_rollup


def run_to_table(df, name, mode="update"):
    """All that is available now, into a memory table (test data only)."""
    q = (df.writeStream.outputMode(mode).format("memory").queryName(name)
         .option("checkpointLocation", tempfile.mkdtemp(prefix="bizlens-st-")).trigger(availableNow=True).start())
    q.awaitTermination()


def test_a_table_of_part_files_streams_whole(spark, small_dir):
    folder = tempfile.mkdtemp(prefix="bizlens-in-")
    spark.read.parquet(f"{small_dir}/orders.parquet").repartition(3).write.parquet(f"{folder}/orders.parquet")
    run_to_table(live_balances(orders_stream(spark, folder)), "live_parts")
    assert spark.table("live_parts").agg(F.max("txn_count")).first()[0] > 0
    n = spark.table("live_parts").groupBy("customer_id").agg(F.max("txn_count").alias("n")).agg(F.sum("n")).first()[0]
    assert n == spark.read.parquet(f"{small_dir}/orders.parquet").count()


def test_live_balances_match_batch_totals(spark, small_dir):
    run_to_table(live_balances(orders_stream(spark, small_dir)), "live_bal")
    live = spark.table("live_bal").groupBy("customer_id").agg(F.max_by("balance", "txn_count").alias("b"))
    d = Domain(spark, small_dir)
    t = d.customer_transactions
    batch = t.groupBy("customer_id").agg(F.sum(F.when(F.col("txn_type") == "deposit", F.col("txn_amount"))
                                               .otherwise(-F.col("txn_amount"))).alias("b"))
    assert sorted(map(tuple, live.collect())) == sorted(map(tuple, batch.collect()))


def test_visit_rollup_matches_batch_visit_summary(spark, small_dir):
    out = visit_rollup(events_stream(spark, small_dir), lookup(spark, "campaign_identifier"),
                       lookup(spark, "page_hierarchy"))
    run_to_table(out, "live_visits", mode="append")
    got = spark.table("live_visits")
    want = spark_queries()["visit_summary_intended"](spark, small_dir)
    # the last day stays open until later events move the watermark past it
    closed = want.join(got.select("visit_id"), "visit_id", "left_semi")
    assert got.count() > 0 and got.count() == closed.count()
    assert sorted(map(tuple, got.select(*closed.columns).collect())) == sorted(map(tuple, closed.collect()))
    assert want.count() - got.count() <= want.select(F.to_date("visit_start_time")).distinct().count() * 200
