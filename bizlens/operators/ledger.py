"""Ledger operators: signed amounts, running balances, month-end balances.

Running balances are computed in two steps so that a customer with a very
large number of transactions does not turn into one huge window partition:
transactions are first reduced to one net amount per (customer, period) by a
hash aggregate with map-side combine, the window then runs over those period
rows (at most one per calendar day or month), and the result is joined back.
A running sum with the default RANGE frame gives every transaction of a day
the balance at the end of that day, which is exactly what the day-level
cumulative sum gives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.operators.keys import join_null_safe

CREDIT_TYPES = ("deposit",)


def signed_amount(txn_type: str = "txn_type", amount: str = "txn_amount") -> Column:
    """Deposits add, every other transaction type subtracts."""
    return F.when(F.col(txn_type).isin(*CREDIT_TYPES), F.col(amount)).otherwise(-F.col(amount))


def period_net(df: DataFrame, key: str, period: Column, out: str = "amount",
               amount: Column | None = None) -> DataFrame:
    """Net signed amount per (key, period)."""
    amt = signed_amount() if amount is None else amount
    return df.groupBy(key, period).agg(F.sum(amt).alias(out))


def cumulative(df: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """Running sum of ``value`` per ``key`` in ``order`` (one row per order value)."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))


def running_balance(df: DataFrame, key: str = "customer_id", ts: str = "txn_date",
                    out: str = "running_balance", keep: Sequence[str] | None = None) -> DataFrame:
    """Balance after each transaction; transactions of the same ``ts``
    share the balance at the end of that ``ts`` (RANGE frame semantics)."""
    cols = keep if keep is not None else df.columns
    daily = period_net(df, key, F.col(ts), "__net")
    daily = cumulative(daily, key, ts, "__net", out).drop("__net")
    return join_null_safe(df.select(*cols), daily, [key, ts])


def closing_balances(txns: DataFrame, key: str = "customer_id", ts: str = "txn_date", amount: Column | None = None) -> DataFrame:
    """The balance at the end of every month from an entity's first
    transaction to the last month of all data, carried over months without
    transactions: ``key, month, net, closing_balance``. The window runs over one
    row per entity and month with transactions; rows without a date are left out."""
    held = _held(txns, key, ts, amount)
    months = held.withColumn("__month", F.explode(F.sequence("month", "__until", F.expr("INTERVAL 1 MONTH"))))
    return months.select(key, F.col("__month").alias("month"),
                         F.when(F.col("__month") == F.col("month"), F.col("net")).otherwise(0).alias("net"), "closing_balance")


def _held(txns: DataFrame, key: str, ts: str, amount: Column | None) -> DataFrame:
    """One row per entity and month with transactions: net, closing balance and
    the last month that it holds for (``__until``)."""
    net = period_net(txns.filter(F.col(ts).isNotNull()), key, F.trunc(ts, "MM").alias("month"), "net", amount)
    last = txns.agg(F.trunc(F.max(ts), "MM")).scalar()
    by_month = Window.partitionBy(key).orderBy("month")
    return cumulative(net, key, "month", "net", "closing_balance").withColumns({
        "__until": F.coalesce(F.add_months(F.lead("month").over(by_month), -1), last), "__first": F.lag("month").over(by_month).isNull(), "__last": last})


def balance_growth(balances: DataFrame, key: str = "customer_id", by: str = "month", value: str = "closing_balance",
                   relative_to_size: bool = True) -> DataFrame:
    """Adds ``pct_increase``, the change of ``value`` from an entity's
    previous row in percent of the previous value (of its size, so that a
    smaller debt is growth); NULL for the first row and after a value of 0."""
    prev = F.lag(value).over(Window.partitionBy(key).orderBy(by))
    den = F.abs(prev) if relative_to_size else prev
    return balances.withColumn("pct_increase", F.try_divide(100 * (F.col(value) - prev), F.nullif(den, F.lit(0))))


def allocation(amounts: DataFrame, by: str, amount: Column, out: str) -> DataFrame:
    """What all entities are allocated per ``by``: the sum of their amounts, none below 0."""
    return amounts.groupBy(by).agg(F.sum(F.greatest(amount, F.lit(0))).alias(out))


def previous_balances(txns: DataFrame, key: str = "customer_id", ts: str = "txn_date", amount: Column | None = None) -> DataFrame:
    """For every month of ``closing_balances`` the balance at the end of
    the month before (0 in an entity's first month), as ``previous_balance``:
    a closing balance opened over the months that follow the ones it holds for."""
    after = F.sequence(F.col("month"), F.least(F.add_months("__until", 1), F.col("__last")), F.expr("INTERVAL 1 MONTH"))
    months = _held(txns, key, ts, amount).withColumn("__month", F.explode(after)).filter(F.col("__first") | (F.col("__month") > F.col("month")))
    return months.select(key, F.col("__month").alias("month"),
                         F.when(F.col("__month") > F.col("month"), F.col("closing_balance")).otherwise(0).alias("previous_balance"))


def trailing_day_balances(txns: DataFrame, days: int = 30, key: str = "customer_id", ts: str = "txn_date",
                          amount: Column | None = None) -> DataFrame:
    """The sum of an entity's end-of-day balances over the last ``days``
    days (any number) of every month from its first transaction on, as
    ``day_balances`` (0 before that transaction); a mean is this divided by ``days``.

    The balances of all days up to day d sum up to (d + 1) * A - B, where A adds
    the amounts and B amount * day of the transactions up to d. A window is the
    difference of two such sums. Both stand still between two marks, where a mark
    is a day with transactions or such a day shifted by ``days`` (from there on it
    lies before the window): an entity's running sums over its marks give every
    month by opening the months between a mark and the next, each month once, and
    no row per day is made. Nothing is gathered after the months are opened."""
    if days < 1:
        raise ValueError("days must be 1 or more")
    amt = signed_amount() if amount is None else amount
    txns = txns.filter(F.col(ts).isNotNull())
    last = txns.agg(F.trunc(F.max(ts), "MM")).scalar()
    daily = txns.groupBy(F.col(key).alias("__k"), F.to_date(ts).alias("__d")).agg(F.sum(amt).alias("__n"))
    # a given number of partitions: fewer would be made for the size of the days, which the months opened from them exceed
    daily = daily.repartition(int(txns.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__k")
    marks = daily.select("__k", "__n", F.unix_date("__d").alias("__day"), F.explode(F.array(F.lit(0), F.lit(days))).alias("__shift"))
    marks = marks.withColumn("__at", F.date_add(F.date_from_unix_date("__day"), F.col("__shift")))
    own = Window.partitionBy("__k").orderBy("__at")
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def running(side: Column, value: Column) -> Column:
        return F.sum(F.when(side, value)).over(upto)

    now, gone = F.col("__shift") == 0, F.col("__shift") > 0
    n, by_day = F.col("__n"), F.col("__n") * F.col("__day")
    sums = marks.select("__k", "__at", F.lead("__at").over(own).alias("__next"), running(now, n).alias("__a"), running(now, by_day).alias("__b"),
                        running(gone, n).alias("__a0"), running(gone, by_day).alias("__b0"))
    # months whose end falls on or after this mark and before the next one (none where marks are on one day, but for the last)
    first = F.trunc("__at", "MM")
    until = F.least(F.add_months(F.trunc("__next", "MM"), -1), last)
    months = sums.withColumn("__m", F.explode(F.when(first <= until, F.sequence(first, until, F.expr("INTERVAL 1 MONTH")))))
    end = F.unix_date(F.last_day("__m")).cast("long")
    total = (end + 1) * F.col("__a") - F.col("__b")
    before = (end - days + 1) * F.col("__a0") - F.col("__b0")
    return months.select(F.col("__k").alias(key), F.col("__m").alias("month"), (total - F.coalesce(before, F.lit(0))).alias("day_balances"))


def balance_stats(txns: DataFrame, key: str = "customer_id", ts: str = "txn_date", amount: Column | None = None) -> DataFrame:
    """Mean, least and greatest balance after each transaction of an
    entity, from one row per (entity, day) weighted by its transactions."""
    amt = signed_amount() if amount is None else amount
    daily = txns.groupBy(key, ts).agg(F.sum(amt).alias("__net"), F.count("*").alias("__n"))
    daily = cumulative(daily, key, ts, "__net", "__balance")
    return daily.groupBy(key).agg(
        F.try_divide(F.sum(F.col("__balance") * F.col("__n")).cast("double"), F.sum("__n")).alias("avg_balance"),
        F.min("__balance").alias("min_balance"), F.max("__balance").alias("max_balance"))
