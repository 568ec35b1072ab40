"""Joins on key columns that treat NULL as a value, as GROUP BY and window
partitions do. Used where an aggregate or a carried value goes back to its rows:
a plain equality would drop the rows whose key is NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on ``keys`` by null-safe equality (a hash
    or sort-merge join, as for plain equality); the keys of ``left`` remain."""
    r = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(r, on, how).drop(*[f"__r_{k}" for k in keys])


#: A key is hot when it holds this share of the rows or more (1 / HOT; so there are HOT such keys at most).
HOT = 256


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and the number of their rows, ``__n``."""
    return df.groupBy(*keys).agg(F.count("*").alias("__n"))


def join_hot(left: DataFrame, right: DataFrame, keys: Sequence[str], counts: DataFrame, how: str = "inner") -> DataFrame:
    """``join_null_safe`` for few keys that hold many rows of ``left`` (``counts``
    are its ``key_counts``; ``how``: inner or left). The rows of a hot key are
    dealt by their hash over as many numbers as there are shuffle partitions and
    meet copies of its rows of ``right``, one for each number; so no key brings
    more than about a HOT-th of the rows to one task."""
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = counts.filter(F.col("__n") * HOT >= counts.agg(F.sum("__n")).scalar()).agg(F.collect_list(F.struct(*keys))).scalar()
    is_hot = F.array_contains("__hot", F.struct(*keys))
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(n)).cast("int")
    r = right.withColumn("__hot", hot).withColumn("__part", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0))))).drop("__hot")
    dealt = left.withColumn("__hot", hot).withColumn("__part", F.when(is_hot, spread).otherwise(0)).drop("__hot")
    return join_null_safe(dealt, r, [*keys, "__part"], how).drop("__part")
