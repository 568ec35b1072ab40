"""As-of (nearest event), status at a date, state transitions and durations.

Spark has no as-of join operator. ``nearest_event`` puts events and anchors in
one ordered sequence per entity and carries the last (or next) event time along
it (``ordered.scan``): over ranges of (entity, time) found by sampled splits,
and across their borders by one edge row. No event meets an anchor that it is
not nearest to, so the work is linear in both, also where one entity has most
of the rows; the nearest times then meet their events in an equi join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from bizlens.operators.keys import join_null_safe
from bizlens.operators.ordered import parts, scan
from bizlens.operators.rank import top_per_group


def nearest_event(events: DataFrame, anchors: DataFrame, key: str, ts: str, anchor_ts: str,
                  direction: str = "after", inclusive: bool = False) -> DataFrame:
    """For each anchor (a key may have several), the event rows of the same
    key nearest to it: the first strictly after (``direction='after'``) or the
    last strictly before (``'before'``); ``inclusive`` allows equality. All
    events at the nearest time are returned (ties kept), each with the anchor's
    time as ``anchor_ts``. Repeated anchors count once; rows without key or time
    are near nothing."""
    if direction not in ("after", "before"):
        raise ValueError(direction)
    after = direction == "after"
    near = nearest_times(events, anchors, key, ts, anchor_ts, after, inclusive)
    return events.join(near, (F.col(key) == F.col("__k")) & (F.col(ts) == F.col("__near"))).drop("__k", "__near").withColumnRenamed("__at", anchor_ts)


def nearest_times(events: DataFrame, anchors: DataFrame, key: str, ts: str, anchor_ts: str, after: bool, inclusive: bool) -> DataFrame:
    """``__k``, ``__at``, ``__near``: the nearest event time of each anchor that has one."""
    when = events.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("__k"), F.col(ts).alias("__t"), F.col(ts).alias("__event"), F.lit(None).cast(anchors.schema[anchor_ts].dataType).alias("__at")).distinct()
    asked = anchors.filter(F.col(key).isNotNull() & F.col(anchor_ts).isNotNull()).select(
        F.col(key).alias("__k"), F.col(anchor_ts).alias("__t"), F.lit(None).cast(events.schema[ts].dataType).alias("__event"), F.col(anchor_ts).alias("__at")).distinct()
    # at equal times the sequence reaches an event before the anchor only where equality counts
    is_event = F.col("__event").isNotNull()
    both = when.unionByName(asked).withColumn("__side", F.when(is_event == F.lit(after == inclusive), 1).otherwise(0))
    # a key has at most one event and one anchor a day, so whole keys are small where times are dates
    small = all(isinstance(t, DateType) for t in (events.schema[ts].dataType, anchors.schema[anchor_ts].dataType))
    if small:
        way = F.desc if after else F.asc
        along = Window.partitionBy("__k").orderBy(way("__t"), way("__side"))
        carried = both.withColumn("__near", F.last("__event", ignorenulls=True).over(along))
    else:
        carried = scan(both, ["__k"], ["__t", "__side"], {"__near": ("last", "__event")}, backward=after)
    return carried.filter(F.col("__at").isNotNull() & F.col("__near").isNotNull()).select("__k", "__at", "__near")


def extreme_rows(df: DataFrame, key: str, ts: str, which: str = "first") -> DataFrame:
    """All rows of each key at its first (or last) ``ts``; ties kept. A rank
    filter with partial WindowGroupLimit: hot keys are reduced in every task
    before the shuffle, and the input is read once."""
    order = F.asc(ts) if which == "first" else F.desc(ts)
    return top_per_group(df, [key], [order], 1, ties=True)


def first_time_in_state(df: DataFrame, key: str, state: str, ts: str, states: dict) -> DataFrame:
    """One row per key with the first ``ts`` at which each state was entered
    (``states`` maps output column -> state value). One aggregate, no self join."""
    return df.groupBy(key).agg(*[
        F.min(F.when(F.col(state) == v, F.col(ts))).alias(name) for name, v in states.items()])


def bin_label(days: Column, width: int = 30) -> Column:
    """Label of a ``width``-day bin ``'1 - 30 days'`` style for a bin index."""
    return F.concat((days * width + 1).cast("string"), F.lit(" - "),
                    ((days + 1) * width).cast("string"), F.lit(" days "))


def time_in_state(df: DataFrame, start: str, end: str, open_end: str = "9999-12-31") -> DataFrame:
    """Closed intervals only, with their length in days."""
    return (df.filter(F.col(end) != F.lit(open_end).cast("date"))
            .withColumn("days", F.datediff(F.col(end), F.col(start))))


def percentiles_by(df: DataFrame, keys: Sequence[str], value: str, ps: dict, width: float | None = None) -> DataFrame:
    """Exact percentiles of ``value`` (not NULL) per group, by rank
    selection: linear interpolation between the two neighbouring ranks, like
    ``quantile_cont``; NULL for a group without values.

    Values are counted per group, a histogram over ranges of (group, value) tells
    which ranges hold the wanted ranks, and only these ranges are ranked. So no
    group's values are gathered anywhere, whatever their number. Ranges come from
    sampled splits or, where a sensible ``width`` of them is known, from that."""
    keys = list(keys)
    every = df.groupBy(*keys, F.col(value).alias("__v")).agg(F.count("*").alias("__n"))
    some = every.filter(F.col("__v").isNotNull())
    counts = parts(some, keys + ["__v"], along="__n") if width is None else some.withColumn("__b", F.floor(F.col("__v") / width))
    ranges = counts.groupBy(*keys, "__b").agg(F.sum("__n").alias("__sum"))
    by = Window.partitionBy(*keys)
    ranges = ranges.select(*keys, "__b", F.sum("__sum").over(by).alias("__total"),
                           (F.sum("__sum").over(by.orderBy("__b")) - F.col("__sum")).alias("__before"), "__sum")
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), (F.lit(float(p)) * (F.col("__total") - 1)).alias("at")) for name, p in ps.items()])
    near = lambda w: (F.floor(w["at"]) < F.col("__before") + F.col("__sum")) & (F.ceil(w["at"]) >= F.col("__before"))
    hit = ranges.withColumn("__wanted", F.filter(wanted, near)).filter(F.size("__wanted") > 0)
    ranked = join_null_safe(counts, hit, keys + ["__b"])
    upto = F.sum("__n").over(Window.partitionBy(*keys, "__b").orderBy("__v")) + F.col("__before")
    ranked = ranked.withColumn("__upto", upto).select(*keys, "__v", "__n", "__upto", F.explode("__wanted").alias("__w"))

    def at_rank(rank: Column) -> Column:  # the value whose rows cover that rank (from 0)
        return F.max(F.when((rank >= F.col("__upto") - F.col("__n")) & (rank < F.col("__upto")), F.col("__v").cast("double")))

    found = ranked.groupBy(*keys, F.col("__w.name").alias("__name"), F.col("__w.at").alias("__at")).agg(
        at_rank(F.floor("__w.at")).alias("__lo"), at_rank(F.ceil("__w.at")).alias("__hi"))
    exact = F.col("__lo") + (F.col("__hi") - F.col("__lo")) * (F.col("__at") - F.floor("__at"))
    null = F.lit(None)
    empty = every.filter(F.col("__v").isNull()).select(*keys, null.cast("string").alias("__name"), null.cast("double").alias("__exact"))
    found = found.select(*keys, "__name", exact.alias("__exact")).unionByName(empty)
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("__name") == n, F.col("__exact"))).alias(n) for n in ps])


def approx_percentiles_by(df: DataFrame, keys: Sequence[str], value: str, ps: dict,
                          accuracy: int = 10000) -> DataFrame:
    """Percentiles from a fixed-size sketch per task and group, for values of
    high cardinality: an existing value near the percentile, not interpolated."""
    return df.groupBy(*keys).agg(*[F.percentile_approx(value, p, accuracy).alias(n) for n, p in ps.items()])


def status_at(events: DataFrame, anchors: DataFrame, key: str, ts: str, anchor_ts: str,
              out: str = "member", yes: str = "Y", no: str = "N") -> DataFrame:
    """Every event with a flag telling whether its entity had reached its
    anchor (e.g. joined the programme) at the event's time; entities without
    an anchor are ``no``. ``anchors`` has one row per entity. A left equi join
    on the entity, no window."""
    a = anchors.select(F.col(key).alias("__k"), F.col(anchor_ts).alias("__at"))
    j = events.join(a, F.col(key) == F.col("__k"), "left")
    return j.withColumn(out, F.when(F.col(ts) >= F.col("__at"), yes).otherwise(no)).drop("__k", "__at")
