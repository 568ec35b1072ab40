"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder for cutting lineage on a cluster."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "bizlens") -> SparkSession:
    """A local[N] session configured like a small cluster: AQE on, UI off,
    shuffle partitions sized to the cores rather than the default 200."""
    n = os.cpu_count() if cores == "*" else int(cores)
    parts = shuffle_partitions or max(2 * n, 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BIZLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (and share local folders)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the setting must name a shared folder and is used as is; an
    unset one is an error, as a folder of the driver's own would be empty or
    partial on the executors. In local mode an unset one becomes a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="bizlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


class TableStore:
    """Derived tables of one input folder written as Parquet under the shared
    checkpoint folder: the CREATE TABLE AS SELECT of the original scripts, on
    request. A store is a snapshot: make a new one when the input changes, and
    ``drop`` it (or leave its ``with`` block) to delete the files."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
        self.names: set[str] = set()
        self.bucketed: set[str] = set()

    def write(self, name: str, df: DataFrame, keys: tuple[str, ...] = (), buckets: int | None = None) -> None:
        """Writes a table; with ``buckets`` and ``keys`` as a catalogue table
        bucketed and sorted by the keys (its files lie in the store, too)."""
        if buckets and keys:
            (df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{self.path}/{name}").format("parquet").saveAsTable(self._table(name)))
            self.bucketed.add(name)
        else:
            df.write.parquet(f"{self.path}/{name}")
        self.names.add(name)

    def _table(self, name: str) -> str:
        return f"store_{self.path.rsplit('/', 1)[-1]}_{name}"

    def read(self, name: str) -> DataFrame:
        if name in self.bucketed:
            return self.spark.table(self._table(name))
        return self.spark.read.parquet(f"{self.path}/{name}")

    def drop(self) -> None:
        """Deletes the store's files; its tables are derived again when read."""
        for name in self.bucketed:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.names.clear()
        self.bucketed.clear()

    def __enter__(self) -> TableStore:
        return self

    def __exit__(self, *_) -> None:
        self.drop()


def cluster_settings(input_bytes: int, executor_cores: int = 4, executors: int = 1000) -> dict:
    """Settings for a large cluster, sized from the input volume: ~256 MB scan
    splits and shuffle partitions, AQE coalescing and skew splitting on."""
    target = 256 * 1024 * 1024
    slots = executor_cores * executors
    initial = max(slots * 2, int(input_bytes / target))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
