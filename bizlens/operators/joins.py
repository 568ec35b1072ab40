"""Interval (range) join: attach to each point the intervals that contain it.

Spark has no range-join operator; a non-equi condition is planned as a nested
loop. Here an interval is cut into aligned blocks of power-of-two lengths (its
dyadic cover: at most two of each length, so at most 2 log2 of its length
blocks, whether it is an hour or a millennium), and a distinct point is looked
up under the block of each length that holds it. A point inside an interval
meets exactly one of its blocks, so this is one equi join without repeats; the
points then meet their matches by value. Nothing grows with the length of the
intervals, and no bucket has to be chosen.

An interval side of a known small size (``max_rows``) is broadcast instead. The
size is checked while the query runs: a larger side ends it with an error rather
than being sent to every executor. Both forms give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, FractionalType, IntegralType, TimestampNTZType

#: Lengths of blocks: 2^0 ... 2^(LEVELS - 1) units, enough for any two timestamps.
LEVELS = 48


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcast; a query ends with an error where it has more rows."""
    n = df.agg(F.count("*")).scalar()
    small = F.when(n <= max_rows, True).otherwise(
        F.raise_error(F.lit(f"more than {max_rows} rows to broadcast")).cast("boolean"))
    return F.broadcast(df.filter(small))


def _unit(types: list[DataType]) -> str:
    """What a place is counted in: values, days or seconds."""
    if all(isinstance(t, IntegralType | FractionalType | DecimalType) for t in types):
        return "value"
    if all(isinstance(t, DateType) for t in types):
        return "day"
    return "ntz" if any(isinstance(t, TimestampNTZType) for t in types) else "second"


def _place(c: str, unit: str) -> Column:
    """A value's place on the line of whole units; never decreasing."""
    if unit == "value":
        return F.floor(c).cast("long")
    if unit == "day":
        return F.unix_date(c).cast("long")
    if unit == "second":
        return F.unix_seconds(F.col(c).cast("timestamp"))
    t = F.col(c).cast("timestamp_ntz")
    return F.unix_date(t.cast("date")).cast("long") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def _right(c: Column, k: Column) -> Column:
    return F.call_function("shiftright", c, k)


def dyadic_cover(first: Column, last: Column, levels: Column | None = None) -> Column:
    """The aligned blocks (``level``, ``block``) that make up the whole numbers
    from ``first`` to ``last``: block b of level k holds b * 2^k to (b + 1) * 2^k - 1.
    ``levels``: the number of lengths to look at, where no interval needs more."""
    def at(k: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        lo, hi = _right(first + size - 1, k), _right(last + 1, k)
        odd = lambda c: c.bitwiseAND(F.lit(1).cast("long")) == 1
        block = lambda keep, b: F.when((lo < hi) & keep, F.struct(k.alias("level"), b.alias("block")))
        return F.array(block(odd(lo), lo), block(odd(hi), hi - 1))

    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), (F.lit(LEVELS) if levels is None else levels) - 1), at)), lambda b: b.isNotNull())


def interval_join(points: DataFrame, intervals: DataFrame, ts: str, start: str, end: str,
                  how: str = "left", max_rows: int | None = None) -> DataFrame:
    """``how`` is ``inner`` or ``left`` (points without an interval stay; other
    kinds are refused). ``max_rows``: broadcast the intervals, which must not be
    more than this. Both ends belong to an interval. A point without a time lies
    in no interval; an interval without an end, or that ends before it starts,
    holds no point."""
    if how not in ("inner", "left"):
        raise ValueError(f"interval_join supports inner and left, not {how}")
    within = F.col(ts).between(F.col(start), F.col(end))
    if max_rows is not None:
        return points.join(checked_broadcast(intervals, max_rows), within, how)
    unit = _unit([points.schema[ts].dataType, intervals.schema[start].dataType, intervals.schema[end].dataType])
    times = points.select(F.col(ts).alias("__ts")).filter(F.col("__ts").isNotNull()).distinct()
    # an open end (e.g. 9999-12-31) needs no cover beyond the points
    span = times.agg(F.min(_place("__ts", unit)).alias("lo"), F.max(_place("__ts", unit)).alias("hi"))
    # and no block is longer than that (one length more, as log2 is rounded)
    longest = F.floor(F.log2(F.col("hi").cast("double") - F.col("lo").cast("double") + 1)).cast("int") + 2
    levels = span.select(F.least(longest, F.lit(LEVELS)).alias("levels")).scalar()
    iv = intervals.withColumns({"__first": F.greatest(_place(start, unit), span.select("lo").scalar()),
                                "__last": F.least(_place(end, unit), span.select("hi").scalar()), "__levels": levels})
    iv = iv.filter(F.col(start).isNotNull() & (F.col(start) <= F.col(end)) & (F.col("__first") <= F.col("__last")))
    iv = iv.withColumn("__at", F.explode(dyadic_cover(F.col("__first"), F.col("__last"), F.col("__levels")))).drop("__first", "__last", "__levels")
    # a point is looked up at the lengths that occur only
    used = iv.select("__at.level").distinct().agg(F.collect_set("level")).scalar()
    asked = times.withColumn("__k", F.explode(used)).select(
        "__ts", F.struct(F.col("__k").alias("level"), _right(_place("__ts", unit), F.col("__k")).alias("block")).alias("__of"))
    met = asked.join(iv, (F.col("__of") == F.col("__at")) & F.col("__ts").between(F.col(start), F.col(end))).drop("__of", "__at")
    return points.join(met, F.col(ts) == F.col("__ts"), how).drop("__ts")
