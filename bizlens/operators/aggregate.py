"""Grouped totals, conditional counts, shares and entity percentages.

All are hash aggregates with a map-side partial step, so a hot key costs one
partial row per task before the shuffle. Totals used as a denominator are
scalar subqueries (run once, no cross join and no single-partition window).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.functions.numeric import ratio_round
from bizlens.operators.keys import join_null_safe


def _keys(keys) -> list:
    if keys is None:
        return []
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def total_by(df: DataFrame, keys, **aggs: Column) -> DataFrame:
    """``groupBy(keys).agg(name=expr, ...)``; no keys -> one row."""
    exprs = [e.alias(n) for n, e in aggs.items()]
    k = _keys(keys)
    return df.groupBy(*k).agg(*exprs) if k else df.agg(*exprs)


def weighted_sum(df: DataFrame, keys, measure: Column, rules: Sequence[tuple[Column, int]], default: int,
                 out: str) -> DataFrame:
    """The sum of ``measure`` times the factor of the first rule whose
    condition holds, else ``default`` (a NULL condition doesn't hold)."""
    factor = F.lit(default)
    for cond, times in reversed(rules):
        factor = F.when(cond, times).otherwise(factor)
    return total_by(df, keys, **{out: F.sum(measure * factor)})


def conditional_counts(df: DataFrame, keys, conds: Mapping[str, Column]) -> DataFrame:
    """One count column per predicate (0 when no row matches)."""
    return total_by(df, keys, **{n: F.count_if(c) for n, c in conds.items()})


def ratio(num, den) -> Column:
    """``num / den`` as double, NULL when the divisor is 0 or NULL."""
    return F.try_divide(F.lit(num) if not isinstance(num, Column) else num,
                        (den if isinstance(den, Column) else F.lit(den)).cast("double"))


def pct(num, den, digits: int | None = None) -> Column:
    v = ratio(num * 100 if isinstance(num, Column) else F.lit(num * 100), den)
    return F.round(v, digits) if digits is not None else v


def scalar(df: DataFrame, expr: Column) -> Column:
    """A one-value aggregate of ``df`` as an uncorrelated scalar subquery."""
    return df.agg(expr).scalar()


def share_of_total(df: DataFrame, measure: str, out: str, digits: int = 2,
                   within: Sequence[str] = ()) -> DataFrame:
    """``measure`` (whole numbers) as a percentage of its total (over all rows, or within
    groups ``within``). The total over all rows is a scalar subquery; within
    groups it is a grouped aggregate joined back on the group keys."""
    within = list(within)
    if not within:
        total = scalar(df, F.sum(measure))
        return df.withColumn(out, ratio_round(F.col(measure), total, digits, 100))
    totals = df.groupBy(*within).agg(F.sum(measure).alias("__total"))
    return (join_null_safe(df, totals, within)
            .withColumn(out, ratio_round(F.col(measure), F.col("__total"), digits, 100))
            .drop("__total"))


def pct_of_entities(df: DataFrame, entity: str, hit: Column, out: str, among: Column | None = None, digits: int = 2) -> DataFrame:
    """One row with the percentage of entities that have a row where
    ``hit`` holds, of all entities or of those with a row where ``among`` holds.
    Two levels: one row of flags per entity (NULL is an entity), then counts."""
    holds = lambda c: F.max(F.coalesce(c, F.lit(False)))
    per = df.groupBy(entity).agg(holds(hit).alias("__hit"), holds(F.lit(True) if among is None else among).alias("__among"))
    return per.agg(ratio_round(F.count_if(F.col("__hit") & F.col("__among")), F.count_if("__among"), digits, 100).alias(out))


def distinct_count(col, rsd: float | None = None) -> Column:
    """Aggregate: number of distinct values, exact; with ``rsd`` an estimate of
    that relative error (HyperLogLog++: a fixed-size sketch per task and group
    instead of a shuffle of every distinct value)."""
    return F.count_distinct(col) if rsd is None else F.approx_count_distinct(col, rsd)
