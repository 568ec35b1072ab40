"""Operator 7: context-triggered piecewise hashing.

A rolling hash over the last seven bytes ends a chunk where it is congruent to
``block - 1`` modulo the block size; each chunk gives one of 64 signature
characters. The block size is 3 * 2^k, the least that lets 64 chunks of that
length cover the text, halved while the signature has under 32 characters. A
fingerprint holds the signatures at the block size and at twice that size:
``block:signature:signature2``. Two fingerprints are compared where their block
sizes agree (same, double or half) by edit distance with insertions and
deletions: 1 - distance / (sum of lengths), the best of the compatible pairs;
0 when no block size agrees. As in the method's definition a signature ends
with its 64th character, which stands for all the rest of the text.

Defined results: null text counts as empty, whose fingerprint is ``3::``; two
empty texts have likeness 1; equal texts have equal fingerprints; a text
without a trigger is one chunk. ``neighbours`` orders rows by descending id,
ties by text, null ids last; repeated rows follow each other; a single row is
its own neighbour; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from bizlens.llm.common import documents, mix64, partitions, slices, small_batches
from bizlens.llm.textbytes import BASE, INVERSE, powers

WINDOW, LENGTH, LEAST_BLOCK, MAX_RANGES = 7, 64, 3, 16_384
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


class Hasher:
    """Fingerprints of byte strings."""

    def fingerprint(self, data: bytes) -> str:
        n = len(data)
        if not n:
            return f"{LEAST_BLOCK}::"
        up, down = powers(BASE, n), powers(INVERSE, n)
        b = np.frombuffer(data, np.uint8)
        # h[i] = sum of byte * base^position before i, so a run's own hash is (h[end] - h[start]) / base^start
        h = np.zeros(n + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up, out=h[1:])
        lag = np.maximum(np.arange(1, n + 1) - WINDOW, 0)
        roll = (mix64((h[1:] - h[lag]) * down[lag]) >> np.uint64(33)).astype(np.uint32)
        block = LEAST_BLOCK
        while block * LENGTH < n:
            block *= 2
        while True:
            one = self._signature(h, roll, down, block)
            if block == LEAST_BLOCK or len(one) >= LENGTH // 2:
                return f"{block}:{one}:{self._signature(h, roll, down, 2 * block)}"
            block //= 2

    def _signature(self, h: np.ndarray, roll: np.ndarray, down: np.ndarray, block: int) -> str:
        ends = np.flatnonzero(roll % np.uint32(block) == block - 1)[: LENGTH - 1] + 1
        if not len(ends) or ends[-1] < len(roll):
            ends = np.append(ends, len(roll))
        starts = np.concatenate([[0], ends[:-1]])
        chunk = mix64((h[ends] - h[starts]) * down[starts])
        return ALPHABET[(chunk >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit for each character of ``a``."""
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    full = row = (1 << len(a)) - 1
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    if a == b:
        return 1.0
    size_a, one_a, two_a = a.split(":")
    size_b, one_b, two_b = b.split(":")
    size_a, size_b = int(size_a), int(size_b)
    pairs = []
    if size_a == size_b:
        pairs = [(one_a, one_b), (two_a, two_b)]
    elif size_a == 2 * size_b:
        pairs = [(one_a, two_b)]
    elif size_b == 2 * size_a:
        pairs = [(two_a, one_b)]
    return max((2 * _common(x, y) / (len(x) + len(y)) for x, y in pairs if x or y), default=0.0)


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """Adds each row's fingerprint."""
    @F.pandas_udf("string")
    def run(texts):
        h = Hasher()
        return texts.map(lambda t: h.fingerprint(t.encode() if t else b""))

    return docs.withColumn(out_col, run(F.col(text_col)))


def neighbours(docs: DataFrame, per_pair: Callable, schema: str) -> DataFrame:
    """``per_pair(id, text, next_text)`` for every row (columns ``doc_id`` and
    ``text``) and the row after it by descending id; the first row follows the
    last.

    Ids are dealt to ranges by quantiles; a range's first rows are also sent to
    the range before it, so every pair meets in one task after a single shuffle
    of the texts. Only range borders (one id per range) reach the driver."""
    spark = docs.sparkSession
    small_batches(spark)
    ranges = min(4 * partitions(spark), MAX_RANGES)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select("doc_id")
    cuts = ids.select(F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)], 10 * ranges)).first()[0]
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def place(x: pd.Series) -> pd.Series:  # range 0 holds the largest ids, the last one the null ids
        at = len(cuts) - np.searchsorted(cuts, x.fillna(0).to_numpy(np.int64), "left")
        return pd.Series(np.where(x.isna(), len(cuts) + 1, at).astype(np.int32))

    heads = {r["at"]: r["head"] for r in ids.groupBy(place("doc_id").alias("at")).agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads)
    before = {p: order[k - 1] for k, p in enumerate(order)}  # the first range follows the last

    @F.pandas_udf("array<int>")
    def deal(x: pd.Series, at: pd.Series) -> pd.Series:  # 2 * range, and 2 * range + 1 where the row is a guest
        out = []
        for i, p in zip(x, at, strict=True):
            first = i == heads[p] or heads[p] is None
            out.append([2 * p, 2 * before[p] + 1] if first else [2 * p])
        return pd.Series(out)

    dealt = (docs.withColumn("at", F.explode(deal("doc_id", place("doc_id"))))
             .select(F.shiftright("at", 1).alias("at"), (F.col("at") % 2).alias("guest"), "doc_id", "text")
             .repartition(partitions(spark), "at")
             .sortWithinPartitions("at", "guest", F.col("doc_id").desc_nulls_last(), "text"))
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None  # range, guest, id and text of the row that waits for its follower
        fn = per_pair()
        for b in batches:
            for lo, hi in slices(b.column(3)):
                part, out = b.slice(lo, hi - lo), []
                for row in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    if state is not None and state[0] == row[0] and not state[1]:
                        out.append(fn(state[2], state[3], row[3]))
                    state = row
                if out:
                    yield pa.RecordBatch.from_pylist(out, arrow)

    return dealt.mapInArrow(run, schema)


def edited(text: str, following: str) -> str:
    """``text`` with its later half (rounded down) replaced by as many first
    code points of ``following``, or all of it where it is shorter."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare():
    hasher = Hasher()
    known: dict = {"text": None, "print": ""}

    def one(doc_id, text, following):
        own = known["print"] if known["text"] == text else hasher.fingerprint(text.encode())
        other = hasher.fingerprint(following.encode())
        known.update(text=following, print=other)  # it is the next row's own
        changed = edited(text, following).encode()
        mark = hasher.fingerprint(changed)
        return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(changed).hexdigest(), "fingerprint": own,
                "edited_fingerprint": mark, "near_edited": likeness(own, mark), "near_next": likeness(own, other)}

    return one


def op7_fingerprints(spark, sf_dir: str) -> DataFrame:
    return neighbours(documents(spark, sf_dir), _compare,
                      "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
