"""Visit roll-up over a stream of click events, closed by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.functions.calendar import wall_clock_instant
from bizlens.functions.lists import ordered_list
from bizlens.operators.joins import checked_broadcast
from bizlens.sources.domain import click_events_from_events
from bizlens.sources.driver import table_stream

VIEW, CART, PURCHASE, IMPRESSION, CLICK = 1, 2, 3, 4, 5


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """The ``events`` table read as a file stream."""
    return table_stream(spark, sf_dir, "events", max_files_per_trigger)


def visit_rollup(events: DataFrame, campaigns: DataFrame, pages_lookup: DataFrame,
                 lateness: str = "1 hour", max_pages: int = 10_000, max_campaigns: int = 1_000) -> DataFrame:
    """One row per visit (user-day) once the watermark passes the day's end:
    start time, page views, cart adds, purchase flag, impressions, clicks, the
    ordered list of products added to the cart, and the campaign running at the
    visit's start. The lookups are static; a larger one than the given bounds
    ends the query rather than being broadcast."""
    # watermarks need a zoned timestamp: one whose UTC day is the visit's day
    ev = (click_events_from_events(events, keep=("user_id",))
          .withColumn("__ts", wall_clock_instant("event_time")).withWatermark("__ts", lateness))
    et = F.col("event_type")
    pages = checked_broadcast(pages_lookup, max_pages)
    ev = ev.join(pages, "page_id", "left").withColumn(
        "__item", F.when(F.col("product_id").isNotNull() & (et == CART), F.col("page_name")))
    visits = ev.groupBy(F.window("__ts", "1 day").alias("day"), "user_id", "visit_id").agg(
        F.min("event_time").alias("visit_start_time"),
        F.count_if(et == VIEW).alias("page_views"), F.count_if(et == CART).alias("cart_adds"),
        F.max((et == PURCHASE).cast("bigint")).alias("purchase"),
        F.count_if(et == IMPRESSION).alias("impression"), F.count_if(et == CLICK).alias("click"),
        # in-visit order = (event time, event id), the order the sequence number encodes
        ordered_list("__item", ["event_time", "event_id"]).alias("cart_products"))
    within = F.col("visit_start_time").between(F.col("start_date"), F.col("end_date"))
    return visits.join(checked_broadcast(campaigns, max_campaigns), within, "left").select(
        "user_id", "visit_id", "visit_start_time", "page_views", "cart_adds", "purchase", "campaign_name",
        "impression", "click", "cart_products")
