"""Operator 2: n-gram Jaccard join through R-trees over count vectors.

A document's set is its distinct shingles (64-bit hashes of word runs). Each
shingle falls in one of 64 groups (more for longer documents, ``LEVELS``, as few
shingles to a group are what tells sets apart), and the counts by group are a
point; two sets share at most the sum of the coordinate minima of their points,
and a set and the sets below an R-tree node at most the sum of the minima with
the node's upper corner. Pairs that this bound leaves are verified on the
shingles. Points of different levels are compared at the coarser one.

Equal sets form one class, and classes are compared:

1. Routing. Under any fixed order of shingles, linked sets share one of their
   first n - ceil(percent * n / 100) + 1; classes meet under these keys. The
   order puts shingles last that a bounded sample of documents (``SAMPLE`` rows)
   repeats; it decides how many classes meet, never which are linked.
2. In the classes of a key of many an R-tree search starts from one class, takes
   all that the bound allows out of the tree, goes on from these, and so on: a
   forest of pairs, as many as classes at most, that connects whatever might be
   linked. Where sizes allow few pairs (``CROWD``), all are listed without points
   and counted over the keys: the overlap of two sets is at most the number of
   keys that they share and the shingles of one that are no keys, so pairs that
   share too few for a link (``least_met``) are dropped, unless a key of many
   links them.
3. The components of these forests are families. Their shingles are made once
   more, and the same search in each family, with exact counts, gives the links.

Large keys and families are split in blocks (by members, and families also by
shingles) whose pairs are separate tasks, so none is capped, and no task emits
more pairs than ``CROWD`` / 2 times its classes.

Defined results: null and empty texts, and texts without words, have no shingle
and link with nothing; rows with null id take part, and a component's id is the
least id in it that is not null; repeated rows are linked with each other; an
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bizlens.llm.common import documents, mix64, perhaps_in, slices, small_batches, stored
from bizlens.llm.components import components
from bizlens.llm.textbytes import text_bytes, words

SAMPLE, BLOCK, BLOCK_SHINGLES, FAN = 20_000, 2048, 1_000_000, 32
#: Classes of a key whose pairs are listed in any case, with more at most half as many pairs to a class; rows that are looked at in one go.
CROWD, MEET_ROWS = 8, 1 << 16
#: Largest set of a level, and its number of groups (a power of 2).
LEVELS = ((250, 64), (4000, 256), (16_000, 1024), (1 << 62, 4096))
FULL = 255  # a stored count from here on stands for any number


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data, offsets = text_bytes(texts)
    w = words(data, offsets)
    factors = [np.uint64(f) for f in mix64(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)]
    n = max(len(w.hash) - k + 1, 0)
    runs = np.zeros(n, np.uint64)
    for j, f in enumerate(factors):
        runs += w.hash[j : j + n] * f
    runs = mix64(runs)
    out, at = [], 0
    for m in w.per_text.tolist():
        if m >= k:
            out.append(np.unique(runs[at : at + m - k + 1]))
        elif m:  # the whole sequence; its length tells it from longer ones
            short = w.hash[at : at + m] * np.array(factors[:m], np.uint64)
            out.append(mix64(np.array([short.sum() ^ np.uint64(m)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += m
    return out


def level(size: np.ndarray) -> np.ndarray:
    return np.searchsorted([top for top, _ in LEVELS], size, "left")


def point(shingles: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount((shingles >> np.uint64(65 - groups.bit_length())).astype(np.int64), minlength=groups)


def packed_point(shingles: np.ndarray) -> bytes:
    groups = LEVELS[int(level(np.array([len(shingles)]))[0])][1]
    return np.minimum(point(shingles, groups), FULL).astype(np.uint8).tobytes()


def points_at(packed: list[bytes], groups: int) -> np.ndarray:
    """Packed points of this level or finer ones as rows; full counts become so
    large that they bound nothing."""
    out = np.empty((len(packed), groups), np.int32)
    for k, p in enumerate(packed):
        x = np.frombuffer(p, np.uint8).astype(np.int32)
        x[x == FULL] = 1 << 20
        out[k] = x if len(x) == groups else x.reshape(groups, -1).sum(axis=1)
    return out


def by_level(size: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """Places of the sets of each level, with those of the next that may be
    linked with them, its number of groups and its largest size."""
    low = 0
    for top, groups in LEVELS:
        own = np.flatnonzero((size > low) & (size * percent <= min(top, 1 << 50) * 100))
        if len(own) > 1 and size[own].min() <= top:
            yield own, groups, top
        low = top


def needed(a, b, percent: int):
    """Least overlap of linked sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def least_met(a, b, percent: int):
    """Least number of common keys of linked sets of sizes a and b."""
    return needed(a, b, percent) + 1 - -(-percent * np.maximum(a, b) // 100)


class CountTree:
    """R-tree over count vectors, packed by size and then by the most varying
    coordinate, from which found points can be taken out."""

    def __init__(self, points: np.ndarray, size: np.ndarray, percent: int):
        self.points, self.size, self.percent = points, size, percent
        slab = max(FAN, int(np.sqrt(len(size) * FAN)))
        by_size = np.argsort(size, kind="stable")
        rank = np.empty(len(size), np.int64)
        rank[by_size] = np.arange(len(size)) // slab
        self.order = np.lexsort((points[:, points.var(axis=0).argmax()], rank))
        first = np.arange(0, len(size), FAN)
        self.upper = np.maximum.reduceat(points[self.order], first, axis=0)
        self.low, self.high = np.minimum.reduceat(size[self.order], first), np.maximum.reduceat(size[self.order], first)
        self.left = np.ones(len(size), bool)
        self.count = np.diff(np.append(first, len(size)))

    def take(self, k: int) -> None:
        self.left[k] = False

    def search(self, k: int) -> np.ndarray:
        """Points still in the tree that might be linked with point ``k``."""
        x, n, p = self.points[k], self.size[k], self.percent
        node = (100 * self.high >= p * n) & (100 * n >= p * self.low)
        node[node] = np.minimum(self.upper[node], x).sum(axis=1) >= needed(n, self.low[node], p)
        at = (np.flatnonzero(node)[:, None] * FAN + np.arange(FAN)).ravel()
        at = self.order[at[at < len(self.order)]]
        at = at[self.left[at]]
        return at[np.minimum(self.points[at], x).sum(axis=1) >= needed(n, self.size[at], p)]


def forest(tree: CountTree, verify: Callable[[int, np.ndarray], np.ndarray] | None = None, sides: np.ndarray | None = None,
           top: int = 1 << 62) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (found, first) of each point and the first of its component, by what
    the tree allows (and ``verify`` confirms). ``sides``: whether a point is of
    the first block, where only pairs across blocks are asked for. ``top``: larger
    points are not paired with each other; the next level tells them apart better."""
    found, source = [], []
    for start in range(len(tree.size)):
        if not tree.left[start]:
            continue
        tree.take(start)
        work = [start]
        while work:
            k = work.pop()
            got = tree.search(k)
            if sides is not None:
                got = got[sides[got] != sides[k]]
            if tree.size[k] > top:
                got = got[tree.size[got] <= top]
            if verify is not None and len(got):
                got = got[verify(k, got)]
            tree.left[got] = False
            work += got.tolist()
            found.append(got)
            source.append(np.full(len(got), start))
    return np.concatenate(found), np.concatenate(source)


def _runs(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from batches sorted by group, and where each group begins (and the end)."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = (pa.concat_tables([held, t]) if held is not None else t).combine_chunks()
        if not len(t):
            continue
        edge = np.zeros(len(t) - 1, bool)
        for c in group:
            x = t[c].to_numpy()
            edge |= x[1:] != x[:-1]
        starts = np.concatenate([[0], np.flatnonzero(edge) + 1])
        if len(starts) > 1:
            yield t.slice(0, int(starts[-1])), starts
        held = t.slice(int(starts[-1]))
    if held is not None and len(held):
        yield held, np.array([0, len(held)])


def _blocks(rows: DataFrame, blocks: str, member: str) -> DataFrame:
    """Deals rows to the pairs of blocks of their group (one block, one pair where it is small)."""
    n = F.col(blocks)
    return (rows.withColumn("own", F.pmod(F.xxhash64(member), n)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
            .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("other", blocks))


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _sides(t: pa.Table) -> np.ndarray | None:
    lo, hi = t["lo"][0].as_py(), t["hi"][0].as_py()
    return None if lo == hi else t["own"].to_numpy() == lo


def _few(size: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs of the classes of a key that may be linked by their sizes; None if they are many."""
    order = np.argsort(size, kind="stable")
    size = size[order]
    after = np.searchsorted(size, size * 100 // percent, "right") - np.arange(1, len(size) + 1)
    if 2 * after.sum() > CROWD * len(size):
        return None
    first = np.repeat(np.arange(len(size)), after)
    second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(after) - after, after)
    return order[first], order[second]


def _meetings(percent: int):
    """Step 2: rows sorted by key become the pairs (a, b) of keys of few, with
    the least number of keys they must meet under, and the classes (a) of the
    other keys. Of a key's classes no more than a few batches are held."""
    def split(key: np.ndarray, ids: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        many = np.diff(starts)
        x, y, crowded = [], [], []
        for m in range(2, CROWD + 1):
            f = starts[:-1][many == m]
            for i in range(m):
                for j in range(i + 1, m):
                    x.append(f + i), y.append(f + j)
        for k in np.flatnonzero(many > CROWD):
            lo, hi = int(starts[k]), int(starts[k + 1])
            if (few := _few(size[lo:hi], percent)) is None:
                crowded.append(np.arange(lo, hi))
            else:
                x.append(lo + few[0]), y.append(lo + few[1])
        x, y = np.concatenate(x), np.concatenate(y)
        near = (100 * size[x] >= percent * size[y]) & (100 * size[y] >= percent * size[x]) & (ids[x] != ids[y])
        x, y = x[near], y[near]
        if len(x):
            yield out(np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y]), least_met(size[x], size[y], percent), None)
        if crowded:
            at = np.concatenate(crowded)
            yield out(ids[at], None, None, key[at])

    def out(a, b, need, key) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a), *(none if c is None else pa.array(c, pa.int64()) for c in (b, need, key))], ["a", "b", "need", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * 3
        parts, rows, crowd = [], 0, None  # crowd: the key at hand, once it is known to be of many
        for b in batches:
            parts.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
            rows += len(b)
            if rows < MEET_ROWS:
                continue
            held = [np.concatenate([h, *(p[c] for p in parts)]) for c, h in enumerate(held)]
            parts, rows = [], 0
            if crowd is not None:
                end = int(np.searchsorted(held[0], crowd, "right"))
                yield out(held[1][:end], None, None, held[0][:end])
                held, crowd = [h[end:] for h in held], crowd if end == len(held[0]) else None
            if not len(held[0]):
                continue
            last = int(np.searchsorted(held[0], held[0][-1], "left"))
            if last:
                yield from split(*(h[:last] for h in held))
                held = [h[last:] for h in held]
            elif len(held[0]) > MEET_ROWS:
                crowd = held[0][0]
                yield out(held[1], None, None, held[0])
                held = [h[:0] for h in held]
        held = [np.concatenate([h, *(p[c] for p in parts)]) for c, h in enumerate(held)]
        if crowd is not None:
            end = int(np.searchsorted(held[0], crowd, "right"))
            yield out(held[1][:end], None, None, held[0][:end])
            held = [h[end:] for h in held]
        if len(held[0]):
            yield from split(*held)

    return run


def _possible(percent: int):
    """Step 2: pairs of classes that the bound allows, a forest per key of many."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in _runs(batches, ["key", "lo", "hi"]):
            ids, size = t["class"].to_numpy(), t["n"].to_numpy()
            packed, levels = t["point"].to_pylist(), level(size)
            many = np.diff(starts)
            out_a, out_b = [], []
            firsts = [(starts[:-1][many == m], m) for m in range(2, 9)]  # small groups: all pairs at once
            pairs = [(f + i, f + j) for f, m in firsts for i in range(m) for j in range(i + 1, m)]
            a, b = (np.concatenate([p[side] for p in pairs] or [np.zeros(0, np.int64)]) for side in (0, 1))
            near = (100 * size[a] >= percent * size[b]) & (100 * size[b] >= percent * size[a])
            a, b = a[near], b[near]
            at = np.minimum(levels[a], levels[b])
            for one in np.unique(at):
                x, y = a[at == one], b[at == one]
                used, back = np.unique(np.concatenate([x, y]), return_inverse=True)
                points = points_at([packed[k] for k in used], LEVELS[one][1])
                for lo in range(0, len(x), 8192):
                    u, v = back[lo : min(lo + 8192, len(x))], back[len(x) + lo : len(x) + min(lo + 8192, len(x))]
                    ok = np.minimum(points[u], points[v]).sum(axis=1) >= needed(size[used[u]], size[used[v]], percent)
                    out_a.append(ids[used[u[ok]]]), out_b.append(ids[used[v[ok]]])
            for k in np.flatnonzero(many > 8):
                lo = int(starts[k])
                sides = _sides(t.slice(lo, int(many[k])))
                for own, groups, top in by_level(size[lo : lo + many[k]], percent):
                    tree = CountTree(points_at([packed[lo + o] for o in own], groups), size[lo + own], percent)
                    x, y = forest(tree, None, None if sides is None else sides[own], top)
                    out_a.append(ids[lo + own[x]]), out_b.append(ids[lo + own[y]])
            if out_a and sum(map(len, out_a)):
                yield _edges(np.concatenate(out_a), np.concatenate(out_b))

    return run


def _index(sets: list[np.ndarray], size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles numbered within a family, set after set; the holders of each
    number in a row, and where its holders begin."""
    every = np.concatenate(sets)
    order = np.argsort(every)
    every = every[order]
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    del every
    flat = np.empty(len(order), np.int32)
    flat[order] = np.cumsum(new, dtype=np.int32) - 1
    holder = np.repeat(np.arange(len(sets), dtype=np.int32), size)[order]
    return flat, holder, np.append(np.flatnonzero(new), len(order))


def _verified(percent: int):
    """Step 3: links in a family, a forest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, starts in _runs(batches, ["family", "lo", "hi"]):
            out_a, out_b = [], []
            for lo, hi in zip(starts, starts[1:], strict=False):
                t = whole.slice(int(lo), int(hi - lo))
                ids, only = np.unique(t["class"].to_numpy(), return_index=True)
                if len(ids) < 2:
                    continue
                sets = [np.frombuffer(x, np.uint64) for x in t["shingles"].take(pa.array(only)).to_pylist()]
                size = np.array([len(s) for s in sets])
                at = np.concatenate([[0], np.cumsum(size)])
                flat, holder, begin = _index(sets, size)

                def verify(k: int, got: np.ndarray, flat=flat, at=at, holder=holder, begin=begin, size=size) -> np.ndarray:
                    own = flat[at[k] : at[k + 1]]
                    if len(got) < 16:
                        same = np.array([np.isin(flat[at[g] : at[g + 1]], own, assume_unique=True).sum() for g in got])
                    else:
                        lens = begin[own + 1] - begin[own]
                        pos = np.arange(lens.sum()) + np.repeat(begin[own] - (np.cumsum(lens) - lens), lens)
                        same = np.bincount(holder[pos], minlength=len(size))[got]
                    return same * (100 + percent) >= percent * (size[k] + size[got])

                sides = _sides(t)
                for own, groups, top in by_level(size, percent):
                    tree = CountTree(np.stack([point(sets[o], groups) for o in own]), size[own], percent)
                    check = lambda k, got, own=own, verify=verify: verify(own[k], own[got])
                    a, b = forest(tree, check, None if sides is None else sides[only][own], top)
                    out_a.append(ids[own[a]]), out_b.append(ids[own[b]])
            if out_a and sum(map(len, out_a)):
                yield _edges(np.concatenate(out_a), np.concatenate(out_b))

    return run


def jaccard_components(docs: DataFrame, shingle: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
                       keys: bool = False) -> DataFrame:
    """Id, ``n_shingles`` and ``component_id`` for every row. ``percent``: the
    least Jaccard similarity in hundredths, compared exactly. ``keys``: also
    ``text_key`` (xxhash64 of the text) and ``component`` (a key of its own, as
    rows of one id may be in several components; null without shingles)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))

    def sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(0)):
                keys, n = np.unique(np.concatenate(shingle_sets(b.column(0).slice(lo, hi - lo), shingle)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])

    total = rows.count()
    share = min(1 << 20, -(-(SAMPLE << 20) // max(total, 1)))  # of 2^20 hash values; about SAMPLE rows
    picked = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share).select("text")
    often = (picked.mapInArrow(sample_counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")).toArrow()
    hot, times = often["key"].to_numpy().view(np.uint64), often["n"].to_numpy()
    by_key = np.argsort(hot)
    hot, times = hot[by_key], times[by_key]
    sent = docs.sparkSession.sparkContext.broadcast((hot, times))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, times = sent.value
        for b in batches:
            for lo, hi in slices(b.column(1)):
                sets, out = shingle_sets(b.column(1).slice(lo, hi - lo), shingle), []
                for s in sets:
                    n = len(s)
                    first = n - -(-percent * n // 100) + 1 if n else 0
                    at = np.searchsorted(hot, s)
                    known = at < len(hot)
                    known[known] = hot[at[known]] == s[known]
                    rare = s[~known]
                    if len(rare) < first:
                        often = s[known]
                        rare = np.concatenate([rare, often[np.argsort(times[at[known]], kind="stable")]])
                    one, two = mix64(s).sum(dtype=np.uint64), mix64(s + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
                    out.append((n, int(one.view(np.int64)), int(two.view(np.int64)), rare[:first].view(np.int64), packed_point(s)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), *(pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()), strict=True))],
                    ["id", "text_key", "n", "class", "check", "keys", "point"])

    made = stored(rows.mapInArrow(describe, "id long, text_key long, n long, class long, check long, keys array<long>, point binary"), "sets")
    classes = made.where("n > 0").groupBy("class", "check", "n").agg(F.min("id").alias("id"), F.first("keys").alias("keys"), F.first("point").alias("point"))
    met = stored(classes.select(F.explode("keys").alias("key"), "class", "n").repartition("key").sortWithinPartitions("key")
                 .mapInArrow(_meetings(percent), "a long, b long, need long, key long"), "met")
    pairs = met.where("key is null").groupBy("a", "b").agg(F.count("*").alias("times"), F.max("need").alias("need")).where("times >= need").select("a", "b")
    crowded = met.where("key is not null").select("key", F.col("a").alias("class"))
    dealt = _blocks(crowded.join(crowded.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), "key"), "blocks", "class")
    group = ["key", "lo", "hi"]
    points = classes.select("class", "n", "point")
    possible = (dealt.join(points, "class").select(*group, "own", "class", "n", "point").repartition(*group).sortWithinPartitions(*group)
                .mapInArrow(_possible(percent), "a long, b long")).unionByName(pairs)
    family = components(possible).withColumnsRenamed({"node": "class", "component": "family"})
    # a class's text is read again at one (id, text), so that rows without an id, or of one id, don't meet each other's classes
    at = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key"))
    family = family.join(made.where("n > 0").groupBy("class").agg(at.alias("at"), F.first("n").alias("n")), "class").select("class", "family", "n", "at.id", F.col("at.text_key").alias("same"))
    parts = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    wanted = stored(family.join(family.groupBy("family").agg(parts.alias("blocks")), "family"), "wanted")
    asked = rows.where(perhaps_in(wanted.select(F.xxhash64("id", "same")))(F.xxhash64("id", "text_key")))
    texts = asked.join(wanted, asked["id"].eqNullSafe(wanted["id"]) & (F.col("text_key") == F.col("same"))).select("text", "class", "family", "blocks")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in slices(b.column(0)):
                part = b.slice(lo, hi - lo)
                sets = shingle_sets(part.column(0), shingle)
                own = np.array([mix64(s).sum(dtype=np.uint64).view(np.int64) for s in sets])
                keep = np.flatnonzero(own == part.column(1).to_numpy())  # rows of one id may differ in text
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(keep)) for c in (1, 2, 3)), pa.array([sets[k].tobytes() for k in keep], pa.binary())],
                                                 ["class", "family", "blocks", "shingles"])

    group = ["family", "lo", "hi"]
    links = (_blocks(texts.mapInArrow(again, "class long, family long, blocks long, shingles binary"), "blocks", "class")
             .repartition(*group).sortWithinPartitions(*group).mapInArrow(_verified(percent), "a long, b long"))
    linked = components(links).withColumnsRenamed({"node": "class", "component": "top"})
    members = made.select("id", "text_key", "n", "class").join(linked, "class", "left").withColumn("top", F.coalesce("top", "class"))
    least = members.where("n > 0").groupBy("top").agg(F.min("id").alias("component_id"))
    return members.join(least, "top", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        *([F.col("text_key"), F.when(F.col("n") > 0, F.col("top")).alias("component")] if keys else []))


def op2_jaccard(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))
