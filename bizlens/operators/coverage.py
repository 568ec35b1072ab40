"""Data-quality and period-coverage operators.

- ``null_share``: percentage of rows with a NULL key
- ``reference_gap``: keys on one side that the other side lacks (anti join)
- ``presence``: number of distinct periods each entity appears in, from bit sets
- ``cumulative_share``: running percentage of entities, most-present first
- ``drop_sparse``: rows of entities seen in fewer than n periods (semi join)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from bizlens.functions.numeric import ratio_round
from bizlens.operators.keys import join_null_safe


def null_share(df: DataFrame, col: str, out: str = "null_perc", digits: int = 2) -> DataFrame:
    """100 * NULL rows / rows; NULL (not 0) when no row is NULL, as the
    original ``SUM(CASE ... THEN 1 END)`` gives."""
    return df.agg(ratio_round(F.sum(F.when(F.col(col).isNull(), 1)), F.count("*"), digits, 100).alias(out))


def reference_gap(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  null_aware: bool = False) -> DataFrame:
    """Rows of ``left`` whose key has no match in ``right`` (NOT EXISTS).

    With ``null_aware`` it follows ``left_key NOT IN (SELECT right_key ...)``:
    no row at all when ``right`` holds a NULL key, and never a row with a NULL
    ``left_key``. The NULL test is one scalar aggregate over ``right``, so the
    anti join itself stays a plain (shuffle or broadcast) hash join instead of
    the nested loop a general null-aware anti join needs."""
    r = right.select(F.col(right_key).alias("__rk"))
    out = left.join(r.filter(F.col("__rk").isNotNull()).distinct(), F.col(left_key) == F.col("__rk"), "left_anti")
    if null_aware:
        no_nulls = r.agg(F.count_if(F.col("__rk").isNull()) == 0).scalar()
        out = out.filter(F.col(left_key).isNotNull() & no_nulls)
    return out


def period_number(df: DataFrame, period: str) -> Column:
    """A period column as a whole number: months for dates, otherwise the value."""
    c = F.col(period)
    return F.year(c) * 12 + F.month(c) if isinstance(df.schema[period].dataType, DateType) else c.cast("long")


def period_bits(df: DataFrame, entity: str, period: str, *more: Column) -> DataFrame:
    """The set of an entity's periods as words of 64 bits: ``__word`` and
    ``__bits`` (bit i is period 64 * word + i). Tasks forward one number for an
    entity and word, however many rows and periods that is; NULL is no period."""
    n = period_number(df, period)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(n, F.lit(64)).cast("int"))
    return df.groupBy(entity, F.floor(n / 64).alias("__word")).agg(F.bit_or(bit).alias("__bits"), *more)


def presence(df: DataFrame, entity: str, period: str, out: str = "total_months",
             distinct: bool = True) -> DataFrame:
    """Periods (distinct months of a date column or distinct whole numbers;
    rows with a period when ``distinct=False``) per entity, from bit sets."""
    if not distinct:
        return df.groupBy(entity).agg(F.count(period).alias(out))
    return period_bits(df, entity, period).groupBy(entity).agg(F.coalesce(F.sum(F.bit_count("__bits").cast("long")), F.lit(0)).alias(out))


def cumulative_share(counts: DataFrame, order: str, value: str, out: str, digits: int = 2) -> DataFrame:
    """Running total of ``value`` in descending ``order`` (one row per
    distinct value, a number) as a percentage of the grand total.

    Two levels: running totals within ranges of ``order`` (sixteen to each
    doubling, so a thousand ranges at most), and of the ranges' totals, the only
    rows that one task sees together."""
    c = counts.withColumn("__b", F.floor(F.log2(F.greatest(F.col(order), F.lit(1))) * 16))
    within = F.sum(value).over(Window.partitionBy("__b").orderBy(F.desc(order)))
    ranges = c.groupBy("__b").agg(F.sum(value).alias("__n"))
    before = F.sum("__n").over(Window.orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select("__b", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy()).alias("__total"))
    j = join_null_safe(c.withColumn("__within", within), ranges, ["__b"])
    return j.withColumn(out, ratio_round(F.col("__before") + F.col("__within"), F.col("__total"), digits, 100)).drop(
        "__b", "__within", "__before", "__total")


def sparse_rows(df: DataFrame, entity: str, period: str, min_periods: int, out: str) -> DataFrame:
    """How many rows belong to entities present in fewer than
    ``min_periods`` periods: one aggregate per entity, then its sum."""
    bits = period_bits(df, entity, period, F.count(entity).alias("__r"))
    per = bits.groupBy(entity).agg(F.sum("__r").alias("__rows"), F.coalesce(F.sum(F.bit_count("__bits")), F.lit(0)).alias("__n"))
    return per.agg(F.coalesce(F.sum(F.when(F.col("__n") < min_periods, F.col("__rows"))), F.lit(0)).alias(out))


def drop_sparse(df: DataFrame, entity: str, period: str, min_periods: int) -> DataFrame:
    """The rows of entities present in fewer than ``min_periods`` periods."""
    sparse = presence(df, entity, period, "__n").filter(F.col("__n") < min_periods).select(entity)
    return df.join(sparse, entity, "left_semi")
