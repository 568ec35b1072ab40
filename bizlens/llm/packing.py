"""Operator 1: best-fit packing of token sequences into bins of several capacities.

A bin has three capacities: tokens, documents and attention cost (the sum of
squared lengths). Items go in by descending length; among the bins that have
room in every capacity an item takes the tightest: least weighted dot product
of its demand and the bin's residual (rule ``dot``) or least weighted norm of
the residual that it leaves (rule ``norm``), both as shares of the capacities. A
new bin opens only where none has room.

All three demands follow from an item's length, so items of a length are alike
and so are bins of equal residuals. The plan is made on counts by length, at
most ``capacity`` rows whatever the number of items: a group of alike bins
takes as many items as fit, one bin after the other, which is what placing
the items singly does, since a bin that took an item is tighter than before and
stays the choice for the next of that length. Each item then finds its place
from its rank among the items of its length.

Defined results: null text counts as empty, which holds its end id alone;
repeated rows are documents of their own; an empty table gives an empty result; other
columns are ignored. A length beyond a capacity is refused, as it fits no bin.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from bizlens.llm.common import documents, py_texts, slices, small_batches, stored
from bizlens.llm.piece_cache import PieceCache, words

CAPACITY = 4096


@dataclass(frozen=True)
class Limits:
    """Capacities of a bin; by default only the tokens can bind."""

    tokens: int = CAPACITY
    documents: int = CAPACITY
    attention: int = CAPACITY * CAPACITY

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], np.float64)


@dataclass
class Plan:
    """Where the items of each length go: from rank ``first`` on, ``each`` items
    to a bin, bins numbered from ``bin``, from offset ``offset`` of the bin."""

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    bin: np.ndarray
    offset: np.ndarray
    bins: int


def plan_packing(lengths: np.ndarray, counts: np.ndarray, limits: Limits = Limits(), rule: str = "dot",
                 weights: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> Plan:
    """Vector best fit, descending, on counts by length."""
    if rule not in ("dot", "norm"):
        raise ValueError(rule)
    room = limits.vector()
    w = np.array(weights, np.float64)
    if len(lengths) and (max(lengths) > limits.tokens or max(lengths) ** 2 > limits.attention or min(lengths) < 1 or limits.documents < 1):
        raise ValueError("a length must be positive and fit a bin")
    # groups of alike bins: residuals, number of bins, first bin's number
    residual, many, number = np.zeros((64, 3), np.int64), np.zeros(64, np.int64), np.zeros(64, np.int64)
    groups, bins, out = 0, 0, []
    for k in np.argsort(-np.asarray(lengths)):
        length, left, rank = int(lengths[k]), int(counts[k]), 0
        need = np.array([length, 1, length * length], np.int64)
        while left:
            r = residual[:groups]
            fits = np.flatnonzero((r >= need).all(axis=1) & (many[:groups] > 0))
            if len(fits):
                share, own = r[fits] / room, need / room
                cost = (w * share * own).sum(axis=1) if rule == "dot" else (w * (share - own) ** 2).sum(axis=1)
                g = int(fits[cost.argmin()])
                most, have = int((residual[g] // need).min()), int(many[g])
            else:
                g, full = -1, np.array([limits.tokens, limits.documents, limits.attention], np.int64)
                most = int((full // need).min())
                have = -(-left // most)  # as many new bins as this length needs
            take = min(left, most * have)
            whole, rest = divmod(take, most)
            before = residual[g].copy() if g >= 0 else full
            start = int(number[g]) if g >= 0 else bins
            out.append((length, rank, most, start, limits.tokens - int(before[0])))
            if g >= 0:  # the bins that are taken leave the group from its front
                number[g] += whole + (rest > 0)
                many[g] -= whole + (rest > 0)
            else:
                bins += have
            for n, fill, at in ((whole, most, start), (1 if rest else 0, rest, start + whole)):
                if n:
                    if groups == len(many):
                        empty = np.flatnonzero(many[:groups] == 0)
                        if len(empty) > groups // 2:
                            alive = np.flatnonzero(many[:groups] > 0)
                            groups = len(alive)
                            residual[:groups], many[:groups], number[:groups] = residual[alive], many[alive], number[alive]
                        else:
                            residual, many, number = (np.concatenate([x, np.zeros_like(x)]) for x in (residual, many, number))
                    residual[groups], many[groups], number[groups] = before - fill * need, n, at
                    groups += 1
            left -= take
            rank += take
    parts = np.array(out, np.int64).reshape(-1, 5)
    parts = parts[np.lexsort((parts[:, 1], parts[:, 0]))]
    return Plan(*parts.T, bins)


def place(plan: Plan, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of the items of these lengths and ranks."""
    wide = np.int64(1) << 46
    at = np.searchsorted(plan.length * wide + plan.first, length * wide + rank, "right") - 1
    k = rank - plan.first[at]
    return plan.bin[at] + k // plan.each[at], plan.offset[at] + k % plan.each[at] * length


def pack(items: DataFrame, length_col: str = "length", limits: Limits = Limits(), rule: str = "dot",
         weights: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a stored table of items that has
    ``task`` and ``nth`` (the item's place among those of its task and length).
    Only counts by length reach the driver."""
    per_task = items.groupBy(F.col(length_col).alias("len"), "task").agg((F.max("nth") + 1).alias("n"))
    before = Window.partitionBy("len").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    counts = items.groupBy(F.col(length_col).alias("len")).agg(F.count("*").alias("n")).collect()
    plan = plan_packing(np.array([r["len"] for r in counts], np.int64), np.array([r["n"] for r in counts], np.int64), limits, rule, weights)
    ranked = (items.withColumnsRenamed({length_col: "len"}).join(per_task, ["len", "task"])
              .withColumn("rank", F.col("before") + F.col("nth")).drop("before", "nth", "task"))
    names = [c for c in ranked.columns if c not in ("len", "rank")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy().astype(np.int64) for c in ("len", "rank"))
            seq, offset = place(plan, length, rank)
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in names), pa.array(length), pa.array(seq), pa.array(offset)],
                                             [*names, length_col, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {ranked.schema[c].dataType.simpleString()}" for c in names)
    return ranked.mapInArrow(run, f"{schema}, `{length_col}` long, sequence_id long, offset long")


@functools.lru_cache(2)
def _cache(path: str) -> PieceCache:
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return PieceCache(t)


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, most: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``most`` ids of every document: id, piece, start, length,
    crc of the ids, and ``task`` and ``nth`` for ``pack``. Stored, as a rerun would number otherwise."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, task, met = _cache(tokenizer_path), TaskContext.get().partitionId(), np.zeros(most + 1, np.int64)
        for b in batches:
            for lo, hi in slices(b.column(1)):
                ids, n = cache.ids([words(t) for t in py_texts(b.column(1).slice(lo, hi - lo))])
                n_docs = hi - lo
                ends = np.cumsum(n + 1)
                flat = np.full(int(ends[-1]), end_id, "<u4")
                inside = np.ones(len(flat), bool)
                inside[ends - 1] = False
                flat[inside] = ids
                count = -(-(n + 1) // most)
                doc = np.repeat(np.arange(n_docs), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * most
                length = np.minimum(n[doc] + 1 - start, most)
                at = (ends - n - 1)[doc] + start
                raw = memoryview(flat.tobytes())
                crc = np.array([zlib.crc32(raw[4 * a : 4 * (a + m)]) for a, m in zip(at.tolist(), length.tolist(), strict=True)], np.int64)
                order = np.argsort(length, kind="stable")
                of = length[order]
                run_start = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
                nth = np.empty(len(doc), np.int64)
                nth[order] = met[of] + np.arange(len(of)) - np.repeat(run_start, np.diff(np.append(run_start, len(of))))
                np.add.at(met, length, 1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, n_docs).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start.astype(np.int64)), pa.array(length.astype(np.int64)),
                     pa.array(crc), pa.array(np.full(len(doc), task, np.int32)), pa.array(nth)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    made = rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long")
    return stored(made, "pieces").withColumnRenamed("doc_id", id_col)


def pack_documents(docs: DataFrame, tokenizer_path: str, limits: Limits = Limits(), rule: str = "dot") -> DataFrame:
    """Packs every document's pieces; see ``pieces`` and ``pack``."""
    return pack(pieces(docs, tokenizer_path, most=limits.tokens), limits=limits, rule=rule)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocabularies

    return pack_documents(documents(spark, sf_dir), vocabularies.path("word_bpe_49k.json")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
