"""Retailer: weekly sales cleaning, exploration and before/after impact.

Domain: ``weekly_sales(week_date text, region, platform, segment,
customer_type, transactions, sales)``. ``clean_weekly_sales`` types the date and
adds calendar and segment columns; every other query reads it.

The event (the reference's packaging change) is the week starting
``EVENT_DATE``: week 24 of its year by the Sunday-based week count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.functions.calendar import day_name, seven_day_week, sunday_week
from bizlens.functions.numeric import ratio_round, ratio_round_sql
from bizlens.operators.aggregate import share_of_total, total_by
from bizlens.operators.impact import (AGE_BANDS, DEMOGRAPHICS, UNKNOWN, band_columns, before_after,
                                      calendar_columns, impact_by_areas, missing_values)
from bizlens.plans import kept, kept_table, query, view_sql
from bizlens.sources.domain import Domain

# --- parameters: the event week, set to the inputs' date range (a Monday in week 24)
EVENT_DATE = "1998-06-15"
EVENT_YEAR = 1998
EVENT_WEEK = 24
AREAS = ("region", "platform", "age_band", "demographic", "customer_type")


@kept("clean_weekly_sales")
def clean_weekly_sales_df(d: Domain, week=sunday_week) -> DataFrame:
    """M5-1: typed and enriched weekly sales."""
    ws = d.weekly_sales.withColumn("week_date", F.to_date("week_date", "yyyy-MM-dd"))
    ws = calendar_columns(ws, "week_date", week).withColumns(band_columns("segment"))
    return ws.select(
        "week_date", "week_number", "month_number", "calendar_year", "region", "platform", "segment",
        "age_band", "demographic", "customer_type", "transactions", "sales",
        ratio_round("sales", "transactions", 2).alias("avg_transactions"))


def _case_sql(expr: str, mapping: dict) -> str:
    return ("CASE " + expr + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
            + f" ELSE '{UNKNOWN}' END")


_CLEAN_SQL = """
SELECT week_date, CAST({week} AS INTEGER) AS week_number, CAST(month(week_date) AS INTEGER) AS month_number,
       CAST(year(week_date) AS INTEGER) AS calendar_year, region, platform, segment,
       {age} AS age_band, {demo} AS demographic, customer_type, transactions, sales,
       {avg} AS avg_transactions
FROM (SELECT * REPLACE (CAST(strptime(week_date, '%Y-%m-%d') AS DATE) AS week_date) FROM weekly_sales)"""

_CLEAN_KW = dict(age=_case_sql("right(segment, 1)", AGE_BANDS), demo=_case_sql("left(segment, 1)", DEMOGRAPHICS),
                 avg=ratio_round_sql("sales", "transactions", 2))
view_sql("clean_weekly_sales", _CLEAN_SQL.format(week="strftime(week_date, '%U')", **_CLEAN_KW))


def _cws(d: Domain) -> DataFrame:
    """The clean table, from a store where one holds it (the original's CTAS)."""
    return kept_table(d, "clean_weekly_sales")


@query("clean_weekly_sales", "SELECT * FROM clean_weekly_sales")
def clean_weekly_sales(d: Domain) -> DataFrame:
    """M5-1: the clean table, week number by the Sunday-based count (as written)."""
    return _cws(d)


@query("clean_weekly_sales_intended", _CLEAN_SQL.format(week="ceil(dayofyear(week_date) / 7)", **_CLEAN_KW))
def clean_weekly_sales_intended(d: Domain) -> DataFrame:
    """M5-1 intended: week 1 is 1-7 January, week 2 is 8-14 January, ..."""
    return clean_weekly_sales_df(d, seven_day_week)


@query("weekday_used", "SELECT DISTINCT dayname(week_date) AS day_of_week FROM clean_weekly_sales")
def weekday_used(d: Domain) -> DataFrame:
    """M5-2.1: weekday names of the week dates."""
    return _cws(d).select(day_name("week_date").alias("day_of_week")).distinct()


@query("missing_weeks", """
SELECT n AS missing_week FROM (SELECT CAST(range AS INTEGER) AS n FROM range(1, 53)) t
WHERE NOT EXISTS (SELECT 1 FROM clean_weekly_sales c WHERE c.week_number = t.n)""")
def missing_weeks(d: Domain) -> DataFrame:
    """M5-2.2: week numbers 1-52 without any row."""
    return missing_values(_cws(d), "week_number", 1, 52, "missing_week")


@query("missing_weeks_by_year", """
SELECT y.calendar_year, CAST(w.range AS INTEGER) AS missing_week
FROM (SELECT DISTINCT calendar_year FROM clean_weekly_sales) y CROSS JOIN range(1, 53) w
WHERE NOT EXISTS (SELECT 1 FROM clean_weekly_sales c WHERE c.calendar_year = y.calendar_year AND c.week_number = w.range)""")
def missing_weeks_by_year(d: Domain) -> DataFrame:
    """M5-2.2 per year: week numbers 1-52 that a year of the data lacks (the
    data begin and end within a year)."""
    return missing_values(_cws(d), "week_number", 1, 52, "missing_week", by="calendar_year")


@query("transactions_by_year", """
SELECT calendar_year, COUNT(transactions) AS num_transactions, CAST(SUM(transactions) AS BIGINT) AS total_transactions
FROM clean_weekly_sales GROUP BY calendar_year""")
def transactions_by_year(d: Domain) -> DataFrame:
    """M5-2.3: rows and transactions per year."""
    return total_by(_cws(d), "calendar_year", num_transactions=F.count("transactions"),
                    total_transactions=F.sum("transactions"))


@query("sales_by_region_month", """
SELECT region, month_number, COUNT(sales) AS count_sales, CAST(SUM(sales) AS BIGINT) AS total_sales
FROM clean_weekly_sales GROUP BY region, month_number""")
def sales_by_region_month(d: Domain) -> DataFrame:
    """M5-2.4: sales per region and month of the year."""
    return total_by(_cws(d), ["region", "month_number"], count_sales=F.count("sales"), total_sales=F.sum("sales"))


@query("transactions_by_platform", """
SELECT platform, COUNT(*) AS count_platform, CAST(SUM(transactions) AS BIGINT) AS total_transactions
FROM clean_weekly_sales GROUP BY platform""")
def transactions_by_platform(d: Domain) -> DataFrame:
    """M5-2.5: rows and transactions per platform."""
    return total_by(_cws(d), "platform", count_platform=F.count("*"), total_transactions=F.sum("transactions"))


def _share_cols_sql(col: str, vals: dict, measure: str) -> str:
    return ",\n  ".join(
        f"{ratio_round_sql(f'MAX(CASE WHEN {col} = {v!r} THEN {measure} END)', f'SUM({measure})', 2, 100)} AS {n}"
        for n, v in vals.items())


def _pivot_share(df: DataFrame, keys, col: str, vals: dict, measure: str) -> DataFrame:
    """Per group: each listed category's share (%) of the group's total."""
    return df.groupBy(*keys).agg(*[
        ratio_round(F.max(F.when(F.lower(F.col(col)) == v.lower(), F.col(measure))), F.sum(measure), 2, 100)
        .alias(n) for n, v in vals.items()])


_PLATFORMS = {"retail_sales_percentage": "Retail", "shopify_sales_percentage": "Shopify"}


@query("platform_share_by_month", f"""
SELECT calendar_year, month_number,
  {_share_cols_sql('platform', _PLATFORMS, 'monthly_sales')}
FROM (SELECT calendar_year, month_number, platform, SUM(sales) AS monthly_sales
      FROM clean_weekly_sales GROUP BY 1, 2, 3) GROUP BY calendar_year, month_number""")
def platform_share_by_month(d: Domain) -> DataFrame:
    """M5-2.6: Retail vs Shopify share of each month's sales."""
    monthly = total_by(_cws(d), ["calendar_year", "month_number", "platform"], monthly_sales=F.sum("sales"))
    return _pivot_share(monthly, ["calendar_year", "month_number"], "platform", _PLATFORMS, "monthly_sales")


# the original compares with lower-case 'unknown' under case-insensitive equality
_DEMOS = {"couples_percentage": "Couples", "families_percentage": "Families", "unknown_percentage": "unknown"}


@query("demographic_share_by_year", f"""
SELECT calendar_year,
  {_share_cols_sql('lower(demographic)', {k: v.lower() for k, v in _DEMOS.items()}, 'yearly_sales')}
FROM (SELECT calendar_year, demographic, SUM(sales) AS yearly_sales FROM clean_weekly_sales GROUP BY 1, 2)
GROUP BY calendar_year""")
def demographic_share_by_year(d: Domain) -> DataFrame:
    """M5-2.7: share of each year's sales by demographic (case-insensitive
    category match, as the original database collation does)."""
    yearly = total_by(_cws(d), ["calendar_year", "demographic"], yearly_sales=F.sum("sales"))
    return _pivot_share(yearly, ["calendar_year"], "demographic", _DEMOS, "yearly_sales")


@query("retail_contribution", f"""
SELECT age_band, demographic, total_retail_sales,
       {ratio_round_sql('total_retail_sales', '(SELECT SUM(sales) FROM clean_weekly_sales WHERE platform = ' + "'Retail')", 2, 100)}
         AS retail_sales_contribution_pct
FROM (SELECT age_band, demographic, CAST(SUM(sales) AS BIGINT) AS total_retail_sales FROM clean_weekly_sales
      WHERE platform = 'Retail' GROUP BY 1, 2)""")
def retail_contribution(d: Domain) -> DataFrame:
    """M5-2.8: Retail sales by age band and demographic and their share of all
    Retail sales."""
    g = total_by(_cws(d).filter(F.col("platform") == "Retail"), ["age_band", "demographic"],
                 total_retail_sales=F.sum("sales"))
    return share_of_total(g, "total_retail_sales", "retail_sales_contribution_pct")


@query("avg_transaction_size", f"""
SELECT calendar_year, platform, {ratio_round_sql('SUM(sales)', 'SUM(transactions)', 0)} AS transaction_size
FROM clean_weekly_sales GROUP BY calendar_year, platform""")
def avg_transaction_size(d: Domain) -> DataFrame:
    """M5-2.9: sales per transaction by year and platform (ratio of sums)."""
    return _cws(d).groupBy("calendar_year", "platform").agg(
        ratio_round(F.sum("sales"), F.sum("transactions"), 0).alias("transaction_size"))


def _ba_sql(weeks: int, year: int | None = None, by: tuple = (), else_zero: bool = False,
            where: str = "") -> str:
    lo, hi = EVENT_WEEK - weeks, EVENT_WEEK + weeks - 1
    yc = f" AND calendar_year = {year}" if year is not None else ""
    e = " ELSE 0" if else_zero else ""
    keys = "".join(f"{b}, " for b in by)
    group = f" GROUP BY {', '.join(by)}" if by else ""
    return f"""
SELECT {keys}before_change_sales, after_change_sales, after_change_sales - before_change_sales AS difference,
  {ratio_round_sql('after_change_sales - before_change_sales', 'before_change_sales', 2, 100)} AS pct_variance
FROM (SELECT {keys}
        CAST(SUM(CASE WHEN week_number BETWEEN {lo} AND {EVENT_WEEK - 1}{yc} THEN sales{e} END) AS BIGINT)
          AS before_change_sales,
        CAST(SUM(CASE WHEN week_number BETWEEN {EVENT_WEEK} AND {hi}{yc} THEN sales{e} END) AS BIGINT)
          AS after_change_sales
      FROM clean_weekly_sales {where}{group})"""


@query("before_after_4w", _ba_sql(4, EVENT_YEAR, else_zero=True, where=f"WHERE calendar_year = {EVENT_YEAR}"))
def before_after_4w(d: Domain) -> DataFrame:
    """M5-3.1: sales 4 weeks before / after the event week."""
    df = _cws(d).filter(F.col("calendar_year") == EVENT_YEAR)
    return before_after(df, EVENT_WEEK, 4, year=EVENT_YEAR, else_zero=True)


@query("before_after_12w", _ba_sql(12, EVENT_YEAR))
def before_after_12w(d: Domain) -> DataFrame:
    """M5-3.2: 12 weeks before / after."""
    return before_after(_cws(d), EVENT_WEEK, 12, year=EVENT_YEAR)


@query("before_after_4w_by_year", _ba_sql(4, by=("calendar_year",)))
def before_after_4w_by_year(d: Domain) -> DataFrame:
    """M5-3.3a: the 4-week comparison around week 24 of every year."""
    return before_after(_cws(d), EVENT_WEEK, 4, by=["calendar_year"])


@query("before_after_12w_by_year", _ba_sql(12, by=("calendar_year",)))
def before_after_12w_by_year(d: Domain) -> DataFrame:
    """M5-3.3b: the 12-week comparison for every year."""
    return before_after(_cws(d), EVENT_WEEK, 12, by=["calendar_year"])


def _impact(area: str):
    def fn(d: Domain) -> DataFrame:
        return before_after(_cws(d), EVENT_WEEK, 12, year=EVENT_YEAR, by=[area])
    fn.__doc__ = f"M5-4: 12-week impact in the event year by {area}."
    return fn


for _a in AREAS:
    query(f"impact_by_{_a}", _ba_sql(12, EVENT_YEAR, by=(_a,)))(_impact(_a))


@query("impact_by_area", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS area, CAST({a} AS VARCHAR) AS value, before_change_sales, after_change_sales, difference, "
    f"pct_variance FROM ({_ba_sql(12, EVENT_YEAR, by=(a,))})" for a in AREAS))
def impact_by_area(d: Domain) -> DataFrame:
    """M5-4, all five breakdowns in one scan (GROUPING SETS), long format."""
    return impact_by_areas(_cws(d), AREAS, EVENT_WEEK, 12, EVENT_YEAR)
