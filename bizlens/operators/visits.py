"""Clickstream operators: product funnel and visit roll-up.

Raw events are reduced before they meet another table: views become one count
per page in each task, cart adds one row per (visit, page), and all events of a
visit one row per (cookie, visit).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.operators.joins import interval_join


@dataclass(frozen=True)
class EventCodes:
    """The event types that the operators tell apart."""

    view: int = 1
    cart: int = 2
    purchase: int = 3
    impression: int = 4
    click: int = 5


def funnel(events: DataFrame, pages: DataFrame, by: Sequence[str], distinct_purchases: bool = True,
           codes: EventCodes = EventCodes()) -> DataFrame:
    """Views, cart adds, purchases (cart adds in a purchasing visit) and
    abandoned cart adds per ``by`` (columns of ``pages``), over the pages with a
    ``product_id`` that have any event.

    ``events``: ``visit_id, page_id, event_type``; ``pages``: one row per
    ``page_id``. With ``distinct_purchases`` a cart add counts once and is
    purchased if its visit has a purchase. Without, it counts once for every
    purchase event of its visit (at least once), as a join of cart adds with
    purchase events does; that multiple is taken from one count per visit."""
    et = F.col("event_type")
    per_page = events.groupBy("page_id").agg(F.count_if(et == codes.view).alias("product_viewed"))
    carts = events.filter(et == codes.cart).groupBy("visit_id", "page_id").agg(F.count("*").alias("adds"))
    bought = events.filter(et == codes.purchase).groupBy("visit_id").agg(F.count("*").alias("k"))
    k = F.coalesce("k", F.lit(0))
    if distinct_purchases:
        carted, purchased = F.col("adds"), F.when(k > 0, F.col("adds")).otherwise(0)
    else:
        carted, purchased = F.col("adds") * F.greatest(k, F.lit(1)), F.col("adds") * k
    carts = carts.join(bought, "visit_id", "left").groupBy("page_id").agg(
        F.sum(carted).alias("carted"), F.sum(purchased).alias("bought"))
    products = pages.filter(F.col("product_id").isNotNull())
    g = per_page.join(carts, "page_id", "left").join(products, "page_id").groupBy(*by).agg(
        F.sum("product_viewed").alias("product_viewed"),
        F.coalesce(F.sum("carted"), F.lit(0)).alias("product_addedtocart"),
        F.coalesce(F.sum("bought"), F.lit(0)).alias("product_purchased"))
    return g.withColumn("product_abandoned", F.col("product_addedtocart") - F.col("product_purchased"))


def visit_summary(events: DataFrame, users: DataFrame, pages: DataFrame, campaigns: DataFrame,
                  campaign_per_event: bool = False, codes: EventCodes = EventCodes(),
                  max_campaigns: int | None = None) -> DataFrame:
    """One row per user and visit: start time, page views, cart adds,
    purchase, impressions, clicks, the products added to the cart in their order
    and the campaign running at the visit's start; purchase is a 1/0 flag.
    With ``campaign_per_event`` the campaign is matched per event instead: a
    visit across a campaign's border gives a row for each, and purchase is a count.

    ``events``: ``visit_id, cookie_id, page_id, event_type, event_time,
    sequence_number``; ``users``: ``user_id, cookie_id``, a cookie may belong to
    several users and a user may have several cookies in a visit. Pages and
    campaigns may be of any number; ``max_campaigns`` states that they are few,
    so that they are sent to all tasks (after a check)."""
    et = F.col("event_type")
    added = F.col("product_id").isNotNull() & (et == codes.cart)
    ev = events.join(pages, "page_id", "left")
    across = ["campaign_name"] if campaign_per_event else []
    if campaign_per_event:
        ev = interval_join(ev, campaigns, "event_time", "start_date", "end_date", "left", max_rows=max_campaigns)

    def counts(of: dict[str, Column]) -> list[Column]:
        return [c.alias(n) for n, c in of.items()]

    names = {"page_views": codes.view, "cart_adds": codes.cart, "purchase": codes.purchase,
             "impression": codes.impression, "click": codes.click}
    item = F.when(added, F.struct("sequence_number", "page_name"))
    per_cookie = ev.groupBy("cookie_id", "visit_id", *across).agg(
        F.min("event_time").alias("visit_start_time"), F.collect_list(item).alias("items"),
        *counts({n: F.count_if(et == c) for n, c in names.items()}))
    per_user = per_cookie.join(users, "cookie_id").groupBy("user_id", "visit_id", *across).agg(
        F.min("visit_start_time").alias("visit_start_time"), F.flatten(F.collect_list("items")).alias("items"),
        *counts({n: F.sum(n) for n in names}))
    purchase = F.col("purchase") if campaign_per_event else (F.col("purchase") > 0).cast("bigint")
    cart = F.when(F.size("items") > 0, F.array_join(F.transform(F.array_sort("items"), lambda x: x["page_name"]), ", "))
    visits = per_user.withColumns({"purchase": purchase, "cart_products": cart})
    if not campaign_per_event:
        visits = interval_join(visits, campaigns, "visit_start_time", "start_date", "end_date", "left", max_rows=max_campaigns)
    return visits.select("user_id", "visit_id", "visit_start_time", "page_views", "cart_adds", "purchase",
                         "campaign_name", "impression", "click", "cart_products")
