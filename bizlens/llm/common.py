"""Helpers shared by the operators of this subpackage.

Batches: an operator that works in Python maps Arrow batches to Arrow batches
(``mapInArrow``) and cuts each batch into slices of bounded text volume, so the
memory of a task depends on the longest single text, not on the batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLICE_BYTES, BATCH_ROWS = 1 << 20, 1000
#: Most bits of a bitmap of ``perhaps_in``.
MOST_BITS = 1 << 26


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).
    Unset is accepted in local mode only, where a scratch folder takes its place."""
    path = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    path = tempfile.mkdtemp(prefix="bizlens-llm-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows in this session: a batch is
    held by the JVM and by the Python worker at once, and texts are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage is
    cut, and a lost executor costs a read of the written files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string array that hold about ``limit`` bytes each (a
    longer single text is a range of its own)."""
    if not len(texts):
        return
    size = np.cumsum(np.array([0 if x is None else x for x in pc.binary_length(texts).to_pylist()], np.int64))
    start = 0
    while start < len(texts):
        before = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, before + limit, "right")))
        yield start, end
        start = end


def py_texts(texts: pa.Array) -> list[str]:
    """Python strings; null becomes the empty text."""
    return ["" if t is None else t for t in texts.to_pylist()]


def gather(offsets: np.ndarray, data: np.ndarray, idx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of ``data[offsets[i]:offsets[i + 1]]`` for i in ``idx``,
    and the length of each of these runs."""
    start = offsets[idx]
    lens = offsets[idx + 1] - start
    at = np.cumsum(lens) - lens
    pos = np.arange(int(lens.sum()), dtype=np.int64) + np.repeat(start - at, lens)
    return data[pos], lens


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values (splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def perhaps_in(hashes: DataFrame) -> Callable[[Column], Column]:
    """A test of 64-bit hashes against a stored column of them: true for all that
    are there and for few others, so that rows which can't match need not be
    shuffled. Two bits a hash in a bitmap of 16 bits a hash or more, up to
    ``MOST_BITS``; a fuller one lets more rows pass and loses none."""
    (name,) = hashes.columns
    bits = min(MOST_BITS, 1 << max(16, (16 * hashes.count()).bit_length()))
    at = F.explode(F.array(*(F.shiftright(name, by).bitwiseAND(bits - 1) for by in (0, 32)))).alias("at")
    words = (hashes.select(at).groupBy(F.shiftright("at", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("held")).toArrow())
    held = np.zeros(bits >> 6, np.int64)
    held[words["word"].to_numpy()] = words["held"].to_numpy()
    bitmap = hashes.sparkSession.createDataFrame(pa.table({"held": pa.array([held], pa.list_(pa.int64()))})).scalar()

    def test(hashed: Column) -> Column:
        yes = F.lit(True)
        for by in (0, 32):
            at = F.shiftright(hashed, by).bitwiseAND(bits - 1)
            yes &= F.getbit(F.get(bitmap, F.shiftright(at, 6).cast("int")), at.bitwiseAND(63).cast("int")) == 1
        return yes

    return test


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def crc_mod(col: str, m: int):
    """crc32 of an id's decimal text, modulo ``m``."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % m
