"""Operator 8: near-duplicate embeddings by iterative quantisation.

Rotations are learned from a bounded sample of distinct vectors (``SAMPLE`` of
them, those of least hash; copies would draw the cuts to their vector):
starting at random, each alternates between the signs of the
rotated vectors and the rotation that best maps the vectors onto these signs;
bits are cut at the sample's median, so they are balanced. Every vector is then
coded by each rotation and indexed in tables keyed by substrings of its codes.
Vectors that share a key in some table are reranked by cosine in double
precision with the original vectors. Equal vectors of a label form one class
that is indexed once. A pair that meets in several tables counts in the first.
Large buckets are split in blocks whose pairs are separate tasks, so no bucket
is capped; pairs are counted, never listed.

A key has ``SPARE`` bits more than the largest label needs to number its classes
(``BITS`` at least), so the strangers that a vector meets in a table do not grow
with the data. Longer keys part more near copies, so there are more tables:
``TABLES``, and on until of the sample's vectors, each turned to exactly the least
cosine in a random direction, a share of ``RECALL`` still meets its original
(``MOST_TABLES`` at most). Closer pairs meet more often.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows without label, link with nothing. Vectors of different
length don't link. Repeated rows are vectors of their own, also rows of one id
with different vectors or labels: links are between classes of equal vectors,
and ids only name what was found. A component's id is its least id, null where
all of its rows lack one; rows without an id are kept in such a component only.
Magnitudes play no part (vectors are scaled by their largest component before
they are squared). An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bizlens.llm.common import stored
from bizlens.llm.components import components

SAMPLE, ROUNDS, BLOCK = 20_000, 30, 1024
BITS, SPARE, TABLES, MOST_TABLES = 12, 2, 32, 512
RECALL, TURNED = 0.99, 2000


def _rotations(x: np.ndarray, rounds: int, seed: int) -> Iterator[np.ndarray]:
    """Rotations of the sample's principal axes, one projection a column."""
    rng, dim = np.random.default_rng(seed), x.shape[1]
    centred = x - x.mean(axis=0)
    _, _, axes = np.linalg.svd(centred.T @ centred)
    v = centred @ axes.T
    while True:
        r = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        for _ in range(rounds):
            b = np.where(v @ r >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(b.T @ v)
            r = (left @ right).T
        yield axes.T @ r


def learn_rotations(x: np.ndarray, bits: int, rounds: int = ROUNDS, seed: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Projections (columns) and thresholds for ``bits`` bits, of several
    rotations where one has too few columns."""
    w = np.concatenate([*itertools.islice(_rotations(x, rounds, seed), -(-bits // x.shape[1]))], axis=1)[:, :bits]
    return w, np.median(x @ w, axis=0)


def learn_tables(x: np.ndarray, bits: int, least: float, tables: int = TABLES, most: int = MOST_TABLES, seed: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Projections and thresholds for tables of ``bits`` bits, as many as let unit vectors of
    cosine ``least`` meet in one."""
    rng = np.random.default_rng(seed + 1)
    some = x[:TURNED]
    away = rng.standard_normal(some.shape)
    away -= (away * some).sum(axis=1, keepdims=True) * some
    away /= np.maximum(np.sqrt((away * away).sum(axis=1, keepdims=True)), 1e-12)
    near = least * some + np.sqrt(max(0.0, 1 - least * least)) * away
    made, w, cut = _rotations(x, ROUNDS, seed), np.zeros((x.shape[1], 0)), np.zeros(0)
    met, have = np.zeros(len(some), bool), 0
    while have < most and (have < tables or met.mean() < RECALL):
        while w.shape[1] < (have + 1) * bits:
            new = next(made)
            w, cut = np.concatenate([w, new], axis=1), np.concatenate([cut, np.median(x @ new, axis=0)])
        own = slice(have * bits, (have + 1) * bits)
        met |= ((some @ w[:, own] >= cut[own]) == (near @ w[:, own] >= cut[own])).all(axis=1)
        have += 1
    return w[:, : have * bits], cut[: have * bits]


def _matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat components as doubles (null: not a number) and offsets; null vectors are empty."""
    lens = [0 if v is None else len(v) for v in vectors]
    flat = vectors.flatten().cast(pa.float64())
    return flat.to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)


def _unit_rows(vectors: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors cut or filled with zeros to ``dim`` components; unusable ones are zero."""
    flat, at = _matrix(vectors)
    out = np.zeros((len(at) - 1, dim))
    for k in range(len(at) - 1):
        x = flat[at[k] : at[k + 1]]
        top = np.abs(x).max() if len(x) else 0.0
        if top > 0 and np.isfinite(top):
            x = x / top
            out[k, : min(dim, len(x))] = x[:dim] / np.sqrt((x * x).sum())
    return out


def near_duplicates(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", sample: int = SAMPLE, bits: int | None = None, block: int = BLOCK) -> DataFrame:
    """Id, ``n_links`` (other vectors with cosine of at least ``least``),
    ``component_id`` and ``kept`` for every row."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vec"))
    v = F.col("vec")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    usable = v.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(v, lambda x: x != 0)
    linkable = F.col("label").isNotNull() & F.coalesce(usable, F.lit(False))
    rows = rows.withColumn("class", F.when(linkable, F.sha2(F.concat_ws(" ", F.lit("v"), F.col("vec").cast("array<string>")), 256)))
    good = rows.where(F.col("class").isNotNull())
    classes = good.groupBy("label", "class").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")  # a class's own number, fixed once written
    train = classes.dropDuplicates(["class"]).select("vec", F.xxhash64("class").alias("h")).orderBy("h").limit(sample).toPandas()
    if train.empty:
        return rows.select(F.col("vec_id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    dim = int(train["vec"].map(len).mode()[0])
    if bits is None:
        largest = classes.groupBy("label").count().agg(F.max("count")).first()[0]
        bits = max(BITS, int(largest - 1).bit_length() + SPARE)
    w, cut = learn_tables(_unit_rows(pa.array(train["vec"]), dim), bits, least)
    tables, place = w.shape[1] // bits, (1 << np.arange(bits)).astype(np.int64)

    @F.pandas_udf("array<long>")
    def table_keys(x: pd.Series) -> pd.Series:
        ones = _unit_rows(pa.array(x), dim) @ w >= cut
        return pd.Series(list(ones.reshape(len(x), tables, bits) @ place))

    classes = classes.withColumn("keys", table_keys("vec")).withColumn("dim", F.size("vec"))
    classes = stored(classes, "vectors")
    bucket = ["label", "dim", "t", "key"]
    keyed = classes.select("rep", "label", "dim", F.posexplode("keys").alias("t", "key"))
    shared = keyed.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / block)
    met = (keyed.join(shared, bucket).withColumn("own", F.pmod(F.xxhash64("rep"), parts))
           .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
           .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")))
    group = [*bucket, "lo", "hi"]
    met = (met.select(*group, "own", "rep").join(classes.select("rep", "copies", "keys", "vec"), "rep")
           .select(*group, "own", "rep", "copies", "keys", "vec").repartition(*group).sortWithinPartitions(*group))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches, group):
            yield from _links(t, least)

    found = stored(met.mapInArrow(run, "rep long, n long, root long"), "links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    classes = (classes.select("label", "class", "rep", "copies", "least_id").join(counts, "rep", "left")
               .join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("component", "rep")))
    named = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = classes.join(named, "root").select(
        F.col("label").alias("of"), F.col("class").alias("same"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), "component_id")
    out = rows.select("vec_id", "label", "class").join(classes, (F.col("label") == F.col("of")) & (F.col("class") == F.col("same")), "left")
    own = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(F.col("vec_id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                      own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))


def _runs(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[pa.Table]:
    """The rows of each group of at least two rows, from batches sorted by group."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([held, t]) if held is not None else t
        g = t.select(group).to_pandas()
        edge = np.flatnonzero((g.iloc[1:].to_numpy() != g.iloc[:-1].to_numpy()).any(axis=1)) + 1
        edges = [0, *edge.tolist()]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if hi - lo > 1:
                yield t.slice(lo, hi - lo)
        held = t.slice(edges[-1])
    if held is not None and len(held) > 1:
        yield held


def _links(t: pa.Table, least: float) -> Iterator[pa.RecordBatch]:
    """Link counts of one block pair, and each linked row's least fellow."""
    t = t.combine_chunks()
    rep, copies = t["rep"].to_numpy(), t["copies"].to_numpy()
    keys = np.stack(t["keys"].to_pandas().to_numpy())
    x = _unit_rows(t["vec"].chunk(0), int(t["dim"][0].as_py()))
    own, lo, hi, at = t["own"].to_numpy(), t["lo"][0].as_py(), t["hi"][0].as_py(), t["t"][0].as_py()
    left, right = (np.flatnonzero(own == lo), np.flatnonzero(own == hi))
    link = x[left] @ x[right].T >= least
    if lo == hi:
        np.fill_diagonal(link, False)
    if not link.any():
        return
    new = link.copy()
    for earlier in range(at):
        new &= keys[left, earlier][:, None] != keys[right, earlier][None, :]
    n = np.zeros(len(rep), np.int64)
    n[left] += new @ copies[right]
    if lo != hi:
        n[right] += new.T @ copies[left]
    order = np.argsort(np.argsort(rep))
    root = order.copy()  # labels in id order, spread along links until they rest
    while True:
        far = len(rep)
        a = np.where(link, root[right][None, :], far).min(axis=1)
        nxt = root.copy()
        nxt[left] = np.minimum(nxt[left], a)
        b = np.where(link, nxt[left][:, None], far).min(axis=0)
        nxt[right] = np.minimum(nxt[right], b)
        if (nxt == root).all():
            break
        root = nxt
    ids = np.sort(rep)
    some = np.flatnonzero((n > 0) | (root != order))
    if len(some):
        yield pa.RecordBatch.from_arrays(
            [pa.array(rep[some]), pa.array(n[some]), pa.array(ids[root[some]])],
            ["rep", "n", "root"])


def op8_embedding_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
