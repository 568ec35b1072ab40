"""Delivery operators on orders (items) and deliveries (text measures)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.functions.calendar import parse_timestamp_ntz, seconds_between
from bizlens.functions.numeric import ratio_round
from bizlens.functions.text import null_token, parse_measure

#: decimals that measures are kept to
SCALE = 4


def exact(value: Column) -> Column:
    """A measure as a whole number of 10^-SCALE units, so sums and means are exact."""
    return F.round(value * 10**SCALE).cast("bigint")


def mean_half_up(value: Column, weight: Column, digits: int) -> Column:
    """Aggregate: weighted mean of an ``exact`` value, rounded once."""
    n = F.sum(F.when(value.isNotNull(), weight))
    return ratio_round(F.sum(value * weight), n * 10**SCALE, digits)


def order_items(items: DataFrame) -> DataFrame:
    """``n`` items per order, customer and order time: the one row per order
    that meets the deliveries."""
    return items.groupBy("order_id", "customer_id", "order_time").agg(F.count("*").alias("n"))


def delivery_metrics(items: DataFrame, deliveries: DataFrame) -> DataFrame:
    """One row per order and delivery: ``n`` items, ``pickup`` time,
    ``to_pickup`` (seconds from order to pickup), ``km`` and ``minutes`` from
    their text, ``speed_kmh`` (1 decimal; NULL where the duration is 0 or
    missing) and ``delivered`` (not cancelled).

    ``items``: ``order_id, customer_id, order_time``, a row per item;
    ``deliveries``: ``order_id, runner_id, pickup_time, distance, duration,
    cancellation`` as text, missing values as NULL, '' or 'null'."""
    km, minutes = parse_measure("distance"), parse_measure("duration")
    parsed = deliveries.select(
        "order_id", "runner_id", parse_timestamp_ntz("pickup_time").alias("pickup"), km.alias("km"), minutes.alias("minutes"),
        null_token("cancellation").isNull().alias("delivered"))
    return order_items(items).join(parsed, "order_id").select(
        "*", seconds_between("order_time", "pickup").alias("to_pickup"), speed_kmh(F.col("km"), F.col("minutes")).alias("speed_kmh"))


def speed_kmh(km: Column, minutes: Column) -> Column:
    return ratio_round(exact(km) * 60, exact(minutes), 1, long=True)
