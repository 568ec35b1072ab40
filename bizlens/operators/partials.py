"""Mergeable partial states: aggregates that are kept by a fine period and file,
and put together to any coarser one.

- ``states`` / ``merge``: sums, counts, extremes and distinct counts as columns
  that add up. A distinct count is kept as a HyperLogLog sketch (``hll``; any
  type, a relative error of about 1.04 / sqrt(2^lg), 1.6 % at 12).
- ``id_bitmaps`` / ``count_ids``: exact distinct counts of whole-number ids as
  bitmaps of 32,768 ids each, one row a period and id range; made for ids that
  are numbered densely (a lone id costs a bitmap of 4 KB).
- ``IncrementalAggregate``: states by input file in the shared folder; a refresh
  reads only files that are new or have changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

#: log2 of a sketch's buckets
LG = 12
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def states(df: DataFrame, keys: Sequence[str], values: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per ``keys`` with the partial state of each value: ``values`` maps
    a name to (``sum``, ``count``, ``min``, ``max`` or ``hll``, source column)."""
    make = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "hll": lambda c: F.hll_sketch_agg(c, F.lit(LG))}
    return df.groupBy(*keys).agg(*[make[kind](src).alias(name) for name, (kind, src) in values.items()])


def merge(parts: DataFrame, keys: Sequence[str], values: dict[str, tuple[str, str]]) -> DataFrame:
    """States put together by ``keys`` (of the states' keys, or made of them)."""
    return parts.groupBy(*keys).agg(*[(F.hll_union_agg(name) if kind == "hll" else _MERGE[kind](name)).alias(name) for name, (kind, _) in values.items()])


def finish(parts: DataFrame, values: dict[str, tuple[str, str]]) -> DataFrame:
    """States as values: sketches become estimates, a count of nothing is 0."""
    def value(name: str, kind: str) -> Column:
        if kind == "hll":
            return F.coalesce(F.hll_sketch_estimate(name), F.lit(0))
        return F.coalesce(F.col(name), F.lit(0)) if kind == "count" else F.col(name)

    return parts.withColumns({name: value(name, kind) for name, (kind, _) in values.items()})


def id_bitmaps(df: DataFrame, keys: Sequence[str], entity: str) -> DataFrame:
    """``keys``, ``id_range`` and ``ids``: the set of whole-number ids seen (NULL is no id)."""
    seen = df.filter(F.col(entity).isNotNull())
    return seen.groupBy(*keys, F.bitmap_bucket_number(entity).alias("id_range")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(entity)).alias("ids"))


def count_ids(bitmaps: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Exact distinct ids per ``keys`` from ``id_bitmaps`` of any finer keys."""
    united = bitmaps.groupBy(*keys, "id_range").agg(F.bitmap_or_agg("ids").alias("ids"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("ids")).alias(out))


def _plain_path(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def _version(changed: Column, size: Column) -> Column:
    return F.concat_ws(":", F.unix_millis(changed).cast("string"), size.cast("string"))


class IncrementalAggregate:
    """An aggregate of a growing folder of Parquet files, kept as partial states
    by input file under ``path`` (in the shared folder).

    ``refresh`` finds the files that are new or whose time or size has changed,
    reads these only, and writes their states as one more load (a partition that
    a repeated attempt overwrites). ``read`` puts the latest states of the files
    that are still there together, to the keys or to coarser ones. So any loads
    in any order give what one load of all files gives. ``keys`` maps names to
    expressions of the input."""

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, Column], values: dict[str, tuple[str, str]]):
        self.spark, self.path, self.keys, self.values = spark, path.rstrip("/"), keys, values

    def _files(self, folder: str) -> DataFrame:
        """The folder's listing; no file is opened."""
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
        return listed.select(_plain_path(F.col("path")).alias("file"), _version(F.col("modificationTime"), F.col("length")).alias("version"), "path")

    def _states(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/states")
        except AnalysisException:  # nothing loaded yet
            return None

    def refresh(self, folder: str) -> int:
        """Number of files read (a file without rows leaves no state and is looked at again)."""
        files, old = self._files(folder), self._states()
        if old is not None:
            files = files.join(old.select("file", "version").distinct(), ["file", "version"], "left_anti")
        load = 0 if old is None else (old.agg(F.max("load")).first()[0] or 0) + 1
        new = [r["path"] for r in files.select("path").collect()]  # what is to be opened, as any read lists it
        if not new:
            return 0
        meta = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        df = self.spark.read.parquet(*new).select("*", _plain_path(meta).alias("file"), _version(F.col("_metadata.file_modification_time"), F.col("_metadata.file_size")).alias("version"))
        parts = states(df.withColumns(self.keys), ["file", "version", *self.keys], self.values)
        (parts.withColumn("load", F.lit(load)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(f"{self.path}/states"))
        return len(new)

    def read(self, folder: str, keys: Sequence[str] | None = None) -> DataFrame:
        """The aggregate over the files now in ``folder``, by ``keys`` (some of the
        aggregate's; all by default)."""
        keys = list(self.keys if keys is None else keys)
        old = self._states()
        if old is None:
            raise ValueError("refresh before reading")
        last = old.join(self._files(folder), ["file", "version"], "left_semi")
        return finish(merge(last, keys, self.values), self.values)
