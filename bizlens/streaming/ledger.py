"""Live account balances from a stream of orders (B4 option 3, real time)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.operators.ledger import signed_amount
from bizlens.sources.domain import transactions_from_orders
from bizlens.sources.driver import table_stream


def orders_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """The ``orders`` table read as a file stream."""
    return table_stream(spark, sf_dir, "orders", max_files_per_trigger)


def live_balances(orders: DataFrame) -> DataFrame:
    """Streaming DataFrame (update mode) of each customer's current balance and
    allocation; the state is three numbers per customer."""
    g = transactions_from_orders(orders).groupBy("customer_id").agg(
        F.sum(signed_amount()).alias("balance"), F.count("*").alias("txn_count"), F.max("txn_date").alias("last_txn_date"))
    return g.select("customer_id", "balance", F.greatest("balance", F.lit(0).cast("bigint")).alias("allocation"),
                    "txn_count", "last_txn_date")
