"""Top-k, top-n per group and arg-max with ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in ``order`` (give a total order for a
    deterministic answer). Planned as TakeOrderedAndProject: each task keeps
    its own top ``k`` and only those reach the final merge."""
    return df.orderBy(*order).limit(k)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1,
                  ties: bool = True, rank_col: str | None = None) -> DataFrame:
    """The top ``n`` rows of each group. ``ties=True`` keeps every row that
    shares the n-th value (``rank``), else exactly ``n`` (``row_number``).
    The filter on the rank lets Spark insert a WindowGroupLimit before the
    shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    fn = F.rank() if ties else F.row_number()
    name = rank_col or "__rank"
    out = df.withColumn(name, fn.over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def argmax_with_ties(df: DataFrame, metric: str) -> DataFrame:
    """Every row whose ``metric`` equals the maximum (a scalar subquery)."""
    return df.filter(F.col(metric) == df.agg(F.max(metric)).scalar())
