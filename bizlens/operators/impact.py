"""Calendar enrichment and before/after impact analysis.

``before_after`` sums a measure over the n weeks before an event week and the
n weeks from it on, for any grouping. It is one hash aggregate with
conditional sums: the partial aggregate runs map-side, so the shuffle carries
one row per group per task whatever the input size. ``impact_by_areas`` does
the per-dimension breakdowns in one pass with GROUPING SETS instead of one
scan per dimension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.functions.calendar import sunday_week
from bizlens.functions.numeric import ratio_round
from bizlens.operators.ordered import scan

# --- fixed values: segment code -> age band / demographic ---------------------
AGE_BANDS = {"1": "Young Adults", "2": "Middle Aged", "3": "Retirees", "4": "Retirees"}
DEMOGRAPHICS = {"C": "Couples", "F": "Families"}
UNKNOWN = "Unknown"
# -------------------------------------------------------------------------------


def _map_code(code: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(code == k, v) if out is None else out.when(code == k, v)
    return out.otherwise(UNKNOWN)


def calendar_columns(df: DataFrame, date: str, week=sunday_week) -> DataFrame:
    """Week number, month number and calendar year of ``date``."""
    return df.withColumns({"week_number": week(date), "month_number": F.month(date),
                           "calendar_year": F.year(date)})


def band_columns(segment: str = "segment") -> dict:
    """Age band from the last character of the segment, demographic from
    the first."""
    return {"age_band": _map_code(F.right(F.col(segment), F.lit(1)), AGE_BANDS),
            "demographic": _map_code(F.left(F.col(segment), F.lit(1)), DEMOGRAPHICS)}


def gap_ranges(present: DataFrame, col: str, lo: int | Column, hi: int | Column, by: str | None = None, bucket: Column | None = None) -> DataFrame:
    """The ranges of whole numbers in [lo, hi] (of 64 bits) that do not
    occur in ``present[col]``, as ``first_missing`` and ``last_missing``; with
    ``by``, that do not occur for each value of that column. A gap lies between a
    value and the one before it, which ``ordered.scan`` carries across sampled
    ranges of values; nothing is enumerated, so the work follows the values
    present, not the domain. NULL is no value."""
    keys = [by] if by else []
    lo, hi = ((x if isinstance(x, Column) else F.lit(x)).cast("long") for x in (lo, hi))
    v = F.col(col).cast("long")
    values = present.filter(v.between(lo, hi)).select(*keys, v.alias("__v"), F.lit(False).alias("__end")).distinct()
    groups = present.select(by).distinct() if by else present.sparkSession.range(1)
    ends = groups.select(*keys, hi.alias("__v"), F.lit(True).alias("__end"))
    cut = None if bucket is None else F.floor((F.col("__v") - lo) / bucket)
    near = scan(values.unionByName(ends), keys, ["__v", "__end"], {"__p": ("last", "__v")}, bucket=cut, exclusive=True)
    prev = F.col("__p")
    first = F.when(prev.isNull(), lo).when(prev < hi, prev + 1)
    last = F.when(F.col("__end"), F.col("__v")).when(F.col("__v") > lo, F.col("__v") - 1)
    return near.select(*keys, first.alias("first_missing"), last.alias("last_missing")).filter(F.col("first_missing") <= F.col("last_missing"))


def missing_values(present: DataFrame, col: str, lo: int, hi: int, out: str, by: str | None = None) -> DataFrame:
    """The numbers of ``gap_ranges`` one by one."""
    gaps = gap_ranges(present, col, lo, hi, by, bucket=F.lit(1 << 16))
    return gaps.select(*([by] if by else []), F.explode(F.sequence(F.col("first_missing").cast("int"), F.col("last_missing").cast("int"))).alias(out))


def _window_sum(measure: str, week: str, lo: int, hi: int, year_col: str | None, year: int | None,
                else_zero: bool) -> Column:
    cond = F.col(week).between(lo, hi)
    if year is not None:
        cond = cond & (F.col(year_col) == year)
    v = F.when(cond, F.col(measure))
    return F.sum(v.otherwise(0) if else_zero else v)


def before_after(df: DataFrame, event_week: int, weeks: int, measure: str = "sales",
                 week: str = "week_number", year_col: str = "calendar_year", year: int | None = None,
                 by: Sequence[str] = (), else_zero: bool = False, digits: int = 2) -> DataFrame:
    """Measure in the ``weeks`` weeks before ``event_week`` and the
    ``weeks`` weeks from it on (optionally only in ``year``), their difference
    and percentage change, per ``by`` group."""
    aggs = [
        _window_sum(measure, week, event_week - weeks, event_week - 1, year_col, year, else_zero)
        .alias("before_change_sales"),
        _window_sum(measure, week, event_week, event_week + weeks - 1, year_col, year, else_zero)
        .alias("after_change_sales"),
    ]
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return _impact_columns(g, digits)


def _impact_columns(g: DataFrame, digits: int) -> DataFrame:
    diff = F.col("after_change_sales") - F.col("before_change_sales")
    return g.withColumns({
        "difference": diff,
        "pct_variance": ratio_round(diff, F.col("before_change_sales"), digits, mult=100)})


def impact_by_areas(df: DataFrame, areas: Sequence[str], event_week: int, weeks: int, year: int,
                    measure: str = "sales", week: str = "week_number",
                    year_col: str = "calendar_year", digits: int = 2) -> DataFrame:
    """O21 over several dimensions in one scan: GROUPING SETS with one set per
    dimension, returned long as (area, value, before, after, difference, pct)."""
    aggs = [
        _window_sum(measure, week, event_week - weeks, event_week - 1, year_col, year, False)
        .alias("before_change_sales"),
        _window_sum(measure, week, event_week, event_week + weeks - 1, year_col, year, False)
        .alias("after_change_sales"),
        F.grouping_id(*areas).alias("__gid"),
    ]
    g = df.groupingSets([[F.col(a)] for a in areas], *areas).agg(*aggs)
    n = len(areas)
    area = None
    value = None
    for i, a in enumerate(areas):
        gid = (2 ** n - 1) - 2 ** (n - 1 - i)  # only column i is grouped
        area = F.when(F.col("__gid") == gid, a) if area is None else area.when(F.col("__gid") == gid, a)
        value = (F.when(F.col("__gid") == gid, F.col(a)) if value is None
                 else value.when(F.col("__gid") == gid, F.col(a)))
    g = g.select(area.alias("area"), value.cast("string").alias("value"),
                 "before_change_sales", "after_change_sales")
    return _impact_columns(g, digits)
