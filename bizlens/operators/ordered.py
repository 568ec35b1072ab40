"""Ordered per-entity computations that stay balanced when one entity is huge.

A plain ``Window.partitionBy(entity)`` sends all rows of an entity to one task;
if one customer holds a third of the data, that task sorts a third of the
data. These operators split each entity's ordered rows into buckets (a value
that is monotone in the order, e.g. the day of a date-ordered history):

1. the per-row work runs in a window over (entity, bucket): small partitions;
2. what crosses bucket borders (a bucket's first/last row, its row count) is
   reduced by a hash aggregate to one row per (entity, bucket), and a window
   over those rows (at most one per bucket value: per calendar day) carries it
   to the neighbouring buckets;
3. the carried values are joined back on (entity, bucket) -- the same
   partitioning as step 1, so raw rows are shuffled once; step 2 reads the
   input again but shuffles only partial aggregates.

Where no such bucket is at hand, or one (entity, bucket) may itself be huge,
``bucket=None`` cuts the ordered rows by sampled splits (``parts``): rows are
numbered by the range of (key, order) they fall into, as many ranges as there
are shuffle partitions, whatever the keys' sizes. ``scan`` carries sums, counts,
extremes and last values over such ranges.

Results equal the single-window form, NULL keys, order values and buckets
included (NULL is a key of its own and comes first in the order); the bucket
must not decrease along the order and the order must be total (add a tie-break).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.operators.keys import join_null_safe


#: Sampled rows for each range.
SAMPLE = 16


def parts(df: DataFrame, by: Sequence[str], out: str = "__b", n: int | None = None, along: str | None = None) -> DataFrame:
    """Adds the number of the range of ``by`` (in ascending order, NULL first)
    that a row falls into: ``n`` ranges (a power of two; by default no fewer than
    the shuffle partitions) of about equal numbers of rows; rows of equal ``by``
    are never apart.

    The splits are a sample: the rows of least hash in each of some groups, so
    every task forwards a bounded number of rows, the sample is the same each
    time it is taken, and it stays within the plan as one scalar subquery. A row
    finds its range by binary search. ``along``: a column of an aggregate that the
    sample reads along, so that it shares the aggregate's exchange with the rows."""
    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = max(n - 1, 1).bit_length()
    n = 1 << steps
    h = F.xxhash64(*by)
    groups = max(n // 4, 1)
    w = Window.partitionBy("__g").orderBy("__h")
    rows = df if along is None else df.filter(F.col(along) >= 0)
    sample = (rows.select(F.struct(*by).alias("__at"), h.alias("__h"), F.pmod(h, F.lit(groups)).alias("__g"))
              .withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= SAMPLE * n // groups))
    sample = sample.agg(F.sort_array(F.collect_set("__at")).alias("a")).select(
        F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda k: F.get("a", (k * F.size("a") / n).cast("int"))))
    d = df.withColumns({"__splits": sample.scalar(), out: F.lit(0)})
    for k in reversed(range(steps)):
        step = 1 << k
        d = d.withColumn(out, F.col(out) + F.when(F.get("__splits", F.col(out) + (step - 1)) <= F.struct(*by), step).otherwise(0))
    return d.drop("__splits")


def _bucketed(df: DataFrame, bucket: Column | None, by: Sequence[str]) -> DataFrame:
    return parts(df, by) if bucket is None else df.withColumn("__b", bucket)


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, tuple[str, str]], bucket: Column | None = None,
         backward: bool = False, exclusive: bool = False) -> DataFrame:
    """Running values within ``keys`` in ``order``: ``values`` maps an output
    column to (``sum``, ``count``, ``min``, ``max`` or ``last``, source column).
    NULL sources count for nothing; ``last`` is the last one that is not NULL.
    ``backward`` runs from the end (``last`` is then the next one), ``exclusive``
    leaves out the row itself. Equal rows of ``keys`` and ``order`` must not
    differ in what is carried. Without ``keys`` the whole table is one sequence."""
    keys, order = list(keys), list(order)
    b0 = _bucketed(df, bucket, keys + order)
    way = F.desc if backward else F.asc
    fns = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}
    local = Window.partitionBy(*keys, "__b").orderBy(*[way(o) for o in order]).rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    b = b0.withColumns({f"__l_{out}": fns[fn](src).over(local) for out, (fn, src) in values.items()})
    # one row a (key, range): what the range adds, then what all before it add up to
    end = F.min if backward else F.max
    edge = {out: end(F.when(F.col(src).isNotNull(), F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col(src).alias("v"))))["v"] if fn == "last" else fns[fn](src) for out, (fn, src) in values.items()}
    edges = b0.groupBy(*keys, "__b").agg(*[c.alias(f"__e_{out}") for out, c in edge.items()])
    before = Window.partitionBy(*keys).orderBy(way("__b")).rowsBetween(Window.unboundedPreceding, -1)
    carry = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}
    edges = edges.select(*keys, "__b", *[carry[fn](f"__e_{out}").over(before).alias(f"__c_{out}") for out, (fn, _) in values.items()])
    j = join_null_safe(b, edges, keys + ["__b"])

    def both(out: str, fn: str) -> Column:
        here, there = F.col(f"__l_{out}"), F.col(f"__c_{out}")
        if fn == "count":
            return here + F.coalesce(there, F.lit(0))
        if fn == "sum":
            return F.coalesce(here + there, here, there)
        return F.least(here, there) if fn == "min" else F.greatest(here, there) if fn == "max" else F.coalesce(here, there)

    return j.withColumns({out: both(out, fn) for out, (fn, _) in values.items()}).drop(
        "__b", *[f"__{x}_{out}" for out in values for x in "lc"])


def lead_lag(df: DataFrame, key: str, order: Sequence[str], cols: dict[str, str], bucket: Column | None = None,
             direction: str = "lead") -> DataFrame:
    """Next (``lead``) or previous (``lag``) row's value of each ``cols`` source
    column, as output column ``cols[src]``, within ``key`` in ``order``."""
    b0 = _bucketed(df, bucket, [key, *order])
    asc = direction == "lead"
    w_in = Window.partitionBy(key, "__b").orderBy(*order)
    fn = F.lead if asc else F.lag
    inner = {f"__in_{src}": fn(src).over(w_in) for src in cols}
    inner["__has"] = fn(F.lit(1)).over(w_in).isNotNull()
    b = b0.withColumns(inner)
    # first (for lead) / last (for lag) row of each bucket, carried to the
    # neighbour; aggregated from the input (map-side partial), not the windowed rows
    edge = F.min if asc else F.max
    fields = [F.col(o).alias(f"o{i}") for i, o in enumerate(order)] + [F.col(c).alias(f"v_{c}") for c in cols]
    edges = b0.groupBy(key, "__b").agg(edge(F.struct(*fields)).alias("__edge"))
    w_b = Window.partitionBy(key).orderBy("__b")
    edges = edges.withColumn("__nb", fn("__edge").over(w_b)).drop("__edge")
    j = join_null_safe(b, edges, [key, "__b"])
    out = {dst: F.when(F.col("__has"), F.col(f"__in_{src}")).otherwise(F.col("__nb")[f"v_{src}"])
           for src, dst in cols.items()}
    return j.withColumns(out).drop("__b", "__nb", "__has", *[f"__in_{s}" for s in cols])


def row_number(df: DataFrame, key: str, order: Sequence[str], bucket: Column | None = None, out: str = "row_number") -> DataFrame:
    """1-based position of each row within ``key`` in ``order``."""
    b0 = _bucketed(df, bucket, [key, *order])
    local = F.row_number().over(Window.partitionBy(key, "__b").orderBy(*order))
    b = b0.withColumn("__local", local)
    counts = b0.groupBy(key, "__b").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(key).orderBy("__b")
                               .rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("__before", F.coalesce(before, F.lit(0))).drop("__n")
    return (join_null_safe(b, counts, [key, "__b"])
            .withColumn(out, (F.col("__before") + F.col("__local")).cast("int"))
            .drop("__b", "__local", "__before"))


def rank_by(df: DataFrame, keys: Sequence[str], order: str, out: str = "rank") -> DataFrame:
    """SQL ``rank()`` within ``keys`` ordered by ``order`` (ascending): 1 + the
    number of rows with a smaller value. Rows are reduced to one count per
    (keys, value) first, so the window runs over distinct values only."""
    keys = list(keys)
    counts = df.groupBy(*keys, order).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*keys).orderBy(order)
                               .rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn(out, (F.coalesce(before, F.lit(0)) + 1).cast("bigint")).drop("__n")
    return join_null_safe(df, counts, keys + [order])
