"""Operator 6: language-model scores by prediction by partial matching (PPM).

The context trie holds the symbols that followed each byte context of order 0
to ``ORDER`` in the training texts. A symbol that a context of n occurrences and q
different symbols has seen c times costs c / (n + q); an unseen one costs the
escape q / (n + q) times its probability one order lower, with the symbols
that the context has seen excluded there (the rest share the whole mass). Order
-1 is uniform over 256 symbols: bytes, and the end of text (0xFF, which UTF-8
never uses; 0xFE stands before the text). All contexts are in the model. Those of
order 0 to 2, and of each higher order those whose share of the training
positions is at least 1 / ``SENT`` (so at most ``SENT`` contexts of an order),
are laid out in full in a trie that each worker holds, so most of a text is scored
by a few table look-ups a byte. A position whose ``ORDER`` symbols are not such a
context is looked up by its gram (context and symbol) in a sent table of the grams
of a share of at least 1 / ``TABLE``; the grams that are in neither are joined to
the stored counts of all orders, so every position gets its exact probability.

Beside it: tokens (words, then one end) with additive smoothing over counts of
all training tokens. Tokens whose share of these is at least 1 / ``TABLE`` (so
at most ``TABLE`` tokens, at any size of the corpus) are looked up in a sent
table; all others are joined to the counts, so every token gets its exact count.

Defined results: null text counts as empty, which has one token, its end; a
null id is never held out; with nothing to learn from, tokens are unknown and
every symbol has probability 1/256; rows are scored one by one, so repeated rows repeat;
an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from bizlens.llm.common import crc_mod, documents, slices, stored
from bizlens.llm.textbytes import text_bytes, words

START, END, ORDER, SENT, TABLE, FLUSH = 0xFE, 0xFF, 4, 1 << 16, 1 << 24, 1 << 21
#: The least share of a context in the model is one in so many: no context is left out.
SHARE = 1 << 63
#: The end token's hash: no word has it but by chance.
END_TOKEN = np.uint64(0x656E64206F662074)


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every byte of every text and each text's end: the ``ORDER`` symbols
    before it and itself, in one number with the earliest symbol on top."""
    n_texts = len(offsets) - 1
    size, wide = np.diff(offsets), ORDER + 1  # each text takes its bytes, its end and the pad before it
    out = np.full(len(data) + wide * n_texts, START, np.uint8)
    out[np.arange(len(data)) + ORDER + wide * np.repeat(np.arange(n_texts), size)] = data
    last = offsets[1:] + ORDER + wide * np.arange(n_texts)
    out[last] = END
    key = np.zeros(len(out) - ORDER if n_texts else 0, np.uint64)
    for k in range(wide):
        key = key << np.uint64(8) | out[k : k + len(key)]
    keep = np.ones(len(out), bool)
    for k in range(ORDER):
        keep[last - size - ORDER + k] = False
    return key[keep[ORDER:]]


class _Counter:
    """Counts of keys; gives them out when there are many."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys: np.ndarray) -> None:
        got, n = np.unique(keys, return_counts=True)
        self.parts.append((got, n))
        self.size += len(got)
        if self.size > 2 * FLUSH:
            self.parts = [self.total()]
            self.size = len(self.parts[0][0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in self.parts])
        got, back = np.unique(keys, return_inverse=True)
        return got, np.bincount(back, np.concatenate([n for _, n in self.parts]), len(got)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task: kind 0 tokens (by hash), kind 1 grams."""
    counters = [_Counter(), _Counter()]

    def out() -> Iterator[pa.RecordBatch]:
        for kind, c in enumerate(counters):
            if c.parts:
                keys, n = c.total()
                for lo in range(0, len(keys), 1 << 18):
                    part = keys[lo : lo + (1 << 18)].astype(np.uint64).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int32)), pa.array(part), pa.array(n[lo : lo + (1 << 18)])], ["kind", "key", "n"])

    for b in batches:
        for lo, hi in slices(b.column(0)):
            data, offsets = text_bytes(b.column(0).slice(lo, hi - lo))
            counters[0].add(np.concatenate([words(data, offsets).hash, np.full(hi - lo, END_TOKEN)]))
            counters[1].add(grams(data, offsets))
        if max(c.size for c in counters) > FLUSH:
            yield from out()
            counters = [_Counter(), _Counter()]
    yield from out()


@dataclass
class Trie:
    """``rows``: log10 probability of each symbol, per context: 256 of order 1,
    then those of each of ``levels``, the sorted contexts of order 2 and up."""

    rows: np.ndarray
    levels: list[np.ndarray]

    def tables(self) -> list[np.ndarray]:
        """The row of every context of three symbols; then for each higher order
        the row that one symbol more leads to (-1: none), by row and symbol. An
        order's first 256 entries are for rows that aren't of the order below."""
        two, three, *more = self.levels
        short = np.arange(1 << 16, dtype=np.int32) & 0xFF
        short[two] = 256 + np.arange(len(two))
        out = [np.tile(short, 1 << 8)]
        base = 256 + len(two)
        out[0][three] = base + np.arange(len(three))
        lower = three
        for order, level in enumerate(more, 4):
            step = np.full((len(lower) + 1) * 256, -1, np.int32)
            parent = np.searchsorted(lower, level & ((1 << 8 * (order - 1)) - 1))
            base += len(lower)
            step[(parent + 1) * 256 + (level >> 8 * (order - 1))] = base + np.arange(len(level))
            out.append(step)
            lower = level
        return out

    def logs(self, tables: list[np.ndarray], g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log10 probability of each gram, and whether its whole context is in the trie."""
        row = tables[0][(g >> np.uint64(8) & np.uint64(0xFFFFFF)).astype(np.int64)]
        base = 256 + len(self.levels[0])
        for order, step in enumerate(tables[1:], 4):
            symbol = (g >> np.uint64(8 * order) & np.uint64(0xFF)).astype(np.int32)
            further = step[np.maximum(row - base + 1, 0) * 256 + symbol]
            row = np.where(further < 0, row, further)
            base += len(self.levels[order - 3])
        logs = self.rows.ravel()[row.astype(np.int64) * 256 + (g & np.uint64(0xFF)).astype(np.int64)].astype(np.float64)
        return logs, row >= base


def blend(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Symbol probabilities of contexts (rows) from their counts and the
    probabilities one order lower, by escape with exclusion."""
    seen = counts > 0
    n, q = counts.sum(axis=1, keepdims=True), seen.sum(axis=1, keepdims=True)
    rest = np.where(seen, 0, lower).sum(axis=1, keepdims=True)
    full = rest <= 0  # every symbol seen: nothing to escape to
    own = counts / np.where(full, np.maximum(n, 1), np.maximum(n + q, 1))
    escaped = lower * (q / np.maximum(n + q, 1)) / np.where(full, 1, rest)
    return np.where(n == 0, lower, np.where(seen, own, escaped))


def build_trie(counted: list[tuple[np.ndarray, np.ndarray]]) -> Trie:
    """The trie from (gram, count) of symbols after contexts of 2, 3, ... symbols."""
    one = np.zeros((256, 256))
    keys, n = counted[0]
    np.add.at(one, (keys >> 8 & 0xFF, keys & 0xFF), n)
    p0 = blend(one.sum(axis=0)[None, :], np.full((1, 256), 1 / 256))
    levels = [np.unique(k >> 8) for k, _ in counted]
    rows = np.empty((256 + sum(map(len, levels)), 256), np.float32)
    rows[:256] = blend(one, np.repeat(p0, 256, axis=0))
    base, below, first_below = 256, np.arange(256), 0
    for order, ((keys, n), level) in enumerate(zip(counted, levels, strict=True), 2):
        order_by = np.argsort(keys)
        keys, n = keys[order_by], n[order_by]
        lower = first_below + np.searchsorted(below, level & ((1 << 8 * (order - 1)) - 1))
        for lo in range(0, len(level), 4096):  # a block of contexts at a time
            block = level[lo : lo + 4096]
            a, b = np.searchsorted(keys >> 8, [block[0], block[-1] + 1])
            c = np.zeros((len(block), 256))
            c[np.searchsorted(block, keys[a:b] >> 8), keys[a:b] & 0xFF] = n[a:b]
            rows[base + lo : base + lo + len(block)] = blend(c, rows[lower[lo : lo + 4096]].astype(np.float64))
        first_below, below, base = base, level, base + len(level)
    np.log10(rows, out=rows)
    return Trie(rows, levels)


@dataclass
class Model:
    trie: Trie
    tokens: DataFrame  # key, n
    frequent: tuple[np.ndarray, np.ndarray]  # sorted keys, counts
    least: int  # count from which a token is frequent
    total: int
    types: int
    levels: list[DataFrame]  # of ``contexts``, for 2 to ``ORDER`` symbols
    sent: tuple[np.ndarray, np.ndarray]  # sorted grams, log10 probabilities


def contexts(level: DataFrame) -> DataFrame:
    """(key, n) of grams of one order with their context, its escape mass ``out``
    (0 where every symbol is seen) and their probability ``p``."""
    of = Window.partitionBy("ctx")
    total, q = F.sum("n").over(of), F.count("*").over(of)
    q = F.when(q < 256, q).otherwise(0)
    return (level.withColumn("ctx", F.shiftright("key", 8)).withColumn("total", total).withColumn("q", q)
            .select("key", "ctx", "n", (F.col("q") / (F.col("total") + F.col("q"))).alias("out"), (F.col("n") / (F.col("total") + F.col("q"))).alias("p")))


def _tail(symbols: int) -> Column:
    """A gram cut to its last symbol and ``symbols`` before it."""
    return F.col("key").bitwiseAND((1 << 8 * (symbols + 1)) - 1)


def unseen(keys: DataFrame, model: Model) -> DataFrame:
    """The log10 probability ``log`` of whole grams by all orders: a seen symbol's
    own, an unseen one's by escape, with the mass of unseen symbols one order lower."""
    sent = keys.sparkSession.sparkContext.broadcast(model.trie)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = sent.value
        row = np.arange(1 << 16) & 0xFF
        row[trie.levels[0]] = 256 + np.arange(len(trie.levels[0]))
        for b in batches:
            k = b.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(10.0 ** trie.rows[row[k >> 8 & 0xFFFF], k & 0xFF].astype(np.float64))], ["key", "low"])

    out = keys.mapInArrow(short, "key long, low double")
    for order in range(3, ORDER + 1):
        level, below = model.levels[order - 2], model.levels[order - 3]
        asked = out.select(F.shiftright(_tail(order), 8).alias("ctx")).distinct()
        seen = level.join(asked, "ctx", "left_semi").select("ctx", "out", _tail(order - 1).alias("less"))
        escape = (seen.join(below.select(F.col("key").alias("less"), F.col("p").alias("taken")), "less").groupBy("ctx")
                  .agg((F.first("out") / (1 - F.sum("taken"))).alias("escape")))
        out = (out.withColumn("gram", _tail(order)).withColumn("ctx", F.shiftright("gram", 8))
               .join(level.select(F.col("key").alias("gram"), "p"), "gram", "left").join(escape, "ctx", "left")
               .select("key", F.coalesce("p", F.coalesce("escape", F.lit(1.0)) * F.col("low")).alias("low")))
    return out.select("key", F.log10("low").alias("log"))


def train(texts: DataFrame, text_col: str = "text") -> Model:
    """Counts of all tokens and contexts of a table of texts."""
    counts = stored(texts.select(F.col(text_col).alias("text")).mapInArrow(_count, "kind int, key long, n long")
                    .groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    tokens, g = counts.where("kind = 0").select("key", "n"), counts.where("kind = 1")
    total, types = (x or 0 for x in tokens.agg(F.sum("n"), F.count("*")).first())
    least = -(-total // TABLE)
    top = tokens.where(F.col("n") >= least).toArrow()
    keys, n = (top[c].to_numpy() for c in ("key", "n"))
    by_key = np.argsort(keys)
    positions = g.agg(F.sum("n")).first()[0] or 0
    counted, levels = [], []
    for order in range(2, ORDER + 1):
        made = g.groupBy(_tail(order).alias("key")).agg(F.sum("n").alias("n"))
        levels.append(stored(contexts(made), "contexts"))
        level = levels[-1]
        if order > 2:  # at most SENT contexts, and so 256 * SENT rows
            often = level.groupBy("ctx").agg(F.sum("n").alias("all")).where(F.col("all") * SENT >= positions).select("ctx")
            level = level.join(F.broadcast(often), "ctx")
        level = level.select("key", "n").toArrow()
        counted.append((level["key"].to_numpy(), level["n"].to_numpy()))
    trie = build_trie(counted)
    common = levels[-1].where(F.col("n") * TABLE >= positions).select("key", F.log10("p").alias("log")).toArrow()
    grams_sent, logs = common["key"].to_numpy(), common["log"].to_numpy()
    order_by = np.argsort(grams_sent)
    return Model(trie, tokens, (keys[by_key], n[by_key]), least, total, types, levels, (grams_sent[order_by], logs[order_by].astype(np.float32)))


def _rare(text: np.ndarray, key: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """The different keys of each of n texts, and how often each is in it."""
    rare = np.stack([text, key], axis=1)
    rare = rare[np.lexsort((rare[:, 1], rare[:, 0]))]
    new = np.ones(len(rare), bool)
    new[1:] = (rare[1:] != rare[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(rare))).astype(np.int32)
    cut = np.searchsorted(rare[first, 0], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(cut, pa.array(rare[first, 1])), pa.ListArray.from_arrays(cut, pa.array(times))


def _places(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each key in sorted ``keys``, and whether it is there."""
    at = np.searchsorted(keys, key)
    known = at < len(keys)
    known[known] = keys[at[known]] == key[known]
    return at, known


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``n_known``, ``base_score`` and ``score``."""
    sent = docs.sparkSession.sparkContext.broadcast((model.trie, model.frequent, model.sent))
    bottom = np.log10(model.total + 0.1 * (model.types + 1))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, (keys, counts), (common, common_logs) = sent.value
        tables, k = trie.tables(), TaskContext.get().partitionId() << 32
        for b in batches:
            for lo, hi in slices(b.column(1)):
                data, offsets = text_bytes(b.column(1).slice(lo, hi - lo))
                w, n = words(data, offsets), hi - lo
                ends = np.cumsum(w.per_text + 1)
                token = np.full(int(ends[-1]), END_TOKEN, np.uint64)
                inside = np.ones(len(token), bool)
                inside[ends - 1] = False
                token[inside] = w.hash
                text = np.repeat(np.arange(n), w.per_text + 1)
                key = token.view(np.int64)
                at, known = _places(keys, key)
                base = np.bincount(text[known], np.log10(counts[at[known]] + 0.1) - bottom, n)
                g = grams(data, offsets)
                logs, whole = trie.logs(tables, g)
                more = np.flatnonzero(~whole)
                place, there = _places(common, g[more].view(np.int64))
                logs[more] = 0
                logs[more[there]] = common_logs[place[there]]
                owner = np.repeat(np.arange(n), np.diff(offsets) + 1)
                left = more[~there]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k + np.arange(n, dtype=np.int64)), b.column(0).slice(lo, n), pa.array(w.per_text + 1),
                     pa.array(np.bincount(text[known], minlength=n).astype(np.int64)), pa.array(base.astype(np.float64)), pa.array(np.bincount(owner, logs, n)),
                     *_rare(text[~known], key[~known], n), *_rare(owner[left], g[left].view(np.int64), n)],
                    ["row", "id", "n_tokens", "n_known", "base", "score", "rare", "times", "grams", "gram_times"])
                k += n

    kind = rows.schema["id"].dataType.simpleString()
    made = stored(rows.mapInArrow(run, f"row long, id {kind}, n_tokens long, n_known long, base double, score double, rare array<long>, times array<int>, grams array<long>, gram_times array<int>"), "scores")
    rare = made.select("row", F.explode(F.arrays_zip("rare", "times")).alias("t")).select("row", F.col("t.rare").alias("key"), F.col("t.times").alias("times"))
    c = F.coalesce("n", F.lit(0))
    rest = (rare.join(model.tokens.where(F.col("n") < model.least), "key", "left").groupBy("row")
            .agg(F.sum(F.col("times") * (F.log10(c + 0.1) - F.lit(float(bottom)))).alias("more"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("seen")))
    met = made.select("row", F.explode(F.arrays_zip("grams", "gram_times")).alias("t")).select("row", F.col("t.grams").alias("key"), F.col("t.gram_times").alias("times"))
    told = stored(unseen(met.select("key").distinct(), model), "grams")
    scored = met.join(told, "key").groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("far"))
    return made.drop("rare", "times", "grams", "gram_times").join(rest, "row", "left").join(scored, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("far", F.lit(0.0))).alias("score"))


def op6_ppm_scores(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(crc_mod("doc_id", 10) == 0, F.lit(False))
    model = train(docs.where(~held_out))
    return score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
