"""Operator 12: repeated passages by prefix-free parsing.

Every byte that lies in a ``length``-byte string which also starts in a
document of smaller id is removed; strings are judged on the input.

Parse. A rolling hash runs over all ``TRIGGER`` bytes; the trigger of a window
of ``length`` bytes is its least rolling hash (the first of equals). Windows in
a row with one trigger make a phrase, which overlaps the next one by
``length - 1`` bytes; equal bytes are cut alike wherever they stand, so
repetitive text has few distinct phrases. The dictionary of a slice of text
holds each distinct phrase once, with its least and greatest document.

Combination. Equal windows have equal triggers, so the order of all windows is
built for one range of triggers at a time: phrase suffixes that end with the
trigger are sorted (as read back from it), what the parse goes on with after
it is sorted, neighbours' common lengths cut either order into classes, and the
pair of classes names a window's bytes. The least document of a class is the
answer for all of its windows. The comparison is of bytes, not of hashes.

At scale texts are packed into slices once; a slice sends its distinct triggers
(4 to 5 bytes each), learns which of them other slices have, sends the distinct
phrases of those, and learns the least document of their windows. A passage in
a third of all documents is one phrase a slice. A trigger in more than
``HEAVY`` distinct phrases (rulings, number tables) is dealt by whole windows
instead, so that no task gathers them all.

Defined results: a null or empty text has no bytes; equal ids (repeated rows)
are no smaller than each other; a null id counts as greater than all others;
texts shorter than ``length`` stay whole; an empty table gives an empty result.
Other columns are ignored. A text is handled whole, in blocks that share
``length - 1`` bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from bizlens.llm.common import documents, gather, mix64, partitions, small_batches, stored
from bizlens.llm.textbytes import BASE, INVERSE, powers, text_bytes

LENGTH, TRIGGER = 50, 20
SLICE_TEXT, BLOCK, BUCKET_TEXT = 1 << 20, 1 << 18, 16 << 20
HEAVY, CHUNK = 4096, 1 << 14
NO_ID = np.iinfo(np.int64).max
KEY_BITS = 48


def shrink(*columns: np.ndarray) -> bytes:
    """Integer columns of one length as compressed byte planes."""
    n = len(columns[0])
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(n, c.itemsize).T.tobytes() for c in columns]
    return zstandard.compress(np.int64(n).tobytes() + b"".join(planes), 1)


def grow(blob: bytes, *types: type) -> list[np.ndarray]:
    data = zstandard.decompress(blob)
    n, at, out = int(np.frombuffer(data, np.int64, 1)[0]), 8, []
    for t in types:
        size = np.dtype(t).itemsize
        planes = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(t).reshape(n))
        at += n * size
    return out


def buckets_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """The range of keys (of ``KEY_BITS`` bits) that each key falls into."""
    return ((key >> np.uint64(KEY_BITS - 32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text) as slices of about ``SLICE_TEXT`` bytes."""
    task, count, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

    def flush() -> pa.RecordBatch:
        rows = pa.record_batch({"id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.large_binary())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_batch(rows)
        return pa.record_batch([pa.array([(task << 32) + count], pa.int64()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                               names=["slice", "bytes", "data"])

    for batch in batches:
        data, at = text_bytes(batch.column(1))
        for k, i in enumerate(batch.column(0).to_pylist()):
            ids.append(i)
            texts.append(data[at[k] : at[k + 1]].tobytes())
            size += int(at[k + 1] - at[k])
            if size >= SLICE_TEXT or len(ids) >= 100_000:
                yield flush()
                count, ids, texts, size = count + 1, [], [], 0
    if ids:
        yield flush()


@dataclass
class Parse:
    """The phrases of one slice: an occurrence starts at ``first``, holds
    ``windows`` windows and has its trigger ``before`` bytes on."""

    data: np.ndarray
    offsets: np.ndarray
    ids: np.ndarray
    length: int = LENGTH
    first: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        cols = [self._block(k) for k in range(0, max(len(self.data) - self.length + 1, 0), BLOCK)]
        cols = [np.concatenate(c) for c in zip(*cols)] if cols else [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64)]
        self.first, self.windows, self.before, key, content = cols
        key >>= np.uint64(64 - KEY_BITS)
        self.doc = self.ids[np.searchsorted(self.offsets, self.first, "right") - 1]
        order = np.lexsort((content, key))
        key, content = key[order], content[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
        at = np.flatnonzero(new)
        self.phrase = np.empty(len(key), np.int64)  # of each occurrence: its dictionary entry
        self.phrase[order] = np.cumsum(new) - 1
        self.key, self.sample = key[at], order[at]
        doc = self.doc[order]
        self.least = np.minimum.reduceat(doc, at) if len(at) else doc
        self.greatest = np.maximum.reduceat(doc, at) if len(at) else doc
        new = np.ones(len(at), bool)
        new[1:] = self.key[1:] != self.key[:-1]
        self.trigger_at = np.flatnonzero(new)  # the dictionary is sorted by trigger
        self.trigger = np.cumsum(new) - 1

    def _block(self, start: int) -> tuple[np.ndarray, ...]:
        d = self.data[start : start + BLOCK + self.length - 1]
        n, span = len(d), self.length - TRIGGER + 1
        up, down = powers(BASE, n), powers(INVERSE, n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((d.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
        roll = mix64((total[TRIGGER:] - total[:-TRIGGER]) * down[: n - TRIGGER + 1])
        low = (roll & ~np.uint64((1 << 21) - 1)) | np.arange(len(roll), dtype=np.uint64)
        reach = 1
        while 2 * reach <= span:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if reach < span:
            low = np.minimum(low[: len(low) - (span - reach)], low[span - reach :])
        least = (low & np.uint64((1 << 21) - 1)).astype(np.int64)
        # windows that a document's border cuts
        borders = self.offsets[np.searchsorted(self.offsets, start, "right") : np.searchsorted(self.offsets, start + n, "left")] - start
        cut = np.zeros(len(least) + 1, np.int32)
        np.add.at(cut, np.clip(borders - self.length + 1, 0, len(least)), 1)
        np.add.at(cut, np.clip(borders, 0, len(least)), -1)
        whole = np.cumsum(cut[:-1]) == 0
        change = np.ones(len(least), bool)
        change[1:] = (least[1:] != least[:-1]) | ~whole[:-1]
        first = np.flatnonzero(whole & change)
        stop = np.append(np.flatnonzero(change | ~whole), len(least))
        windows = stop[np.searchsorted(stop, first, "right")] - first
        end = first + windows + self.length - 1
        content = mix64((total[end] - total[first]) * down[first]) ^ mix64(windows.astype(np.uint64))
        t = least[first]
        return first + start, windows, t - first, mix64(~roll[t]), content  # least hashes are small ones: mixed again, keys are spread evenly

    def trigger_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct triggers in order, and in how many distinct phrases each is."""
        return self.key[self.trigger_at], np.diff(np.append(self.trigger_at, len(self.key))).astype(np.uint32)

    def outgoing(self, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        """What other slices must be asked about, sorted by key: the key, the
        phrase, its first window asked about, and how many. ``codes`` of each
        trigger: 1 where other slices have it, 2 where it is heavy."""
        here = np.zeros(len(self.trigger_at), np.int64)
        if len(here):
            here[:] = np.minimum.reduceat(self.least, self.trigger_at) < np.maximum.reduceat(self.greatest, self.trigger_at)
        code = np.maximum(codes, here)[self.trigger]
        one, many = np.flatnonzero(code == 1), np.flatnonzero(code == 2)
        count = self.windows[self.sample]
        each, j = np.repeat(many, count[many]), _ranges(count[many])
        start = self.first[self.sample[each]] + j
        key = np.concatenate([self.key[one], self._window_keys(start)])
        phrase, j = np.concatenate([one, each]), np.concatenate([np.zeros(len(one), np.int64), j])
        n = np.concatenate([count[one], np.ones(len(each), np.int64)])
        order = np.argsort(key, kind="stable")
        return key[order], phrase[order], j[order], n[order]

    def _window_keys(self, start: np.ndarray) -> np.ndarray:
        h = np.zeros(len(start), np.uint64)
        for k in range(self.length):
            h = (h + self.data[start + k].astype(np.uint64) + np.uint64(1)) * np.uint64(BASE)
        return mix64(h) >> np.uint64(64 - KEY_BITS)


def _ranges(counts: np.ndarray) -> np.ndarray:
    return np.arange(int(counts.sum()), dtype=np.int64) - np.repeat(np.cumsum(counts) - counts, counts)


def _parses(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[int, Parse, np.ndarray, list[dict]]]:
    for batch in batches:
        for k in range(batch.num_rows):
            rows = pa.ipc.open_stream(batch.column("data")[k].as_buffer()).read_next_batch()
            data, at = _bytes_of(rows.column("text"))
            raw = rows.column("id")
            ids = raw.fill_null(NO_ID).to_numpy(zero_copy_only=False)
            replies = sorted(batch.column("replies")[k].as_py() or [], key=lambda r: r["bucket"]) if "replies" in batch.schema.names else []
            yield batch.column("slice")[k].as_py(), Parse(data, at, ids, length), raw, replies


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] else np.zeros(0, np.uint8)), at - at[0]


def _messages(number: int, key: np.ndarray, buckets: int, content: Callable[[slice], list]) -> Iterator[pa.RecordBatch]:
    """One row a bucket that any of the sorted keys falls into."""
    bucket = buckets_of(key, buckets)
    at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
    rows = [(int(bucket[a]), number, content(slice(a, b))) for a, b in zip(at, [*at[1:], len(key)])]
    if rows:
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                               *[pa.array(c, pa.binary()) for c in zip(*[r[2] for r in rows])]], names=["bucket", "slice", "head", "body"][: 2 + len(rows[0][2])])


def _steps(key: np.ndarray) -> np.ndarray:
    """Differences of sorted keys, which compress to few bytes."""
    return np.diff(key, prepend=np.uint64(0))


def _common(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a byte matrix, and each sorted row's common length
    with the row before."""
    n, width = words.shape
    wide = np.zeros((n, -(-width // 8) * 8), np.uint8)
    wide[:, :width] = words
    order = np.lexsort(wide.view(">u8").astype(np.uint64).T[::-1])
    s = words[order]
    same = np.logical_and.accumulate(s[1:] == s[:-1], axis=1).sum(axis=1)
    return order, np.concatenate([[-1], same])


def _classes(order: np.ndarray, common: np.ndarray, size: int) -> np.ndarray:
    """Numbers that are equal where the first ``size`` bytes are."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < size)
    return out


def least_documents(key: np.ndarray, windows: np.ndarray, before: np.ndarray, least: np.ndarray, greatest: np.ndarray, data: np.ndarray, at: np.ndarray, length: int) -> list[np.ndarray]:
    """For phrases sorted by key: (phrase, window, document) wherever the least
    document of a window's class is smaller than the phrase's greatest one."""
    found: list[list[np.ndarray]] = [[], [], []]
    borders = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
    start = 0
    while start < len(key):
        # whole keys only; a key of many phrases is dealt by windows, so a chunk is bounded
        stop = int(borders[max(np.searchsorted(borders, start + CHUNK, "right") - 1, np.searchsorted(borders, start, "right"))])
        me = np.arange(start, stop)
        b, w, base = before[me], windows[me], at[me]
        size = w + length - 1
        last = len(data) - 1
        col = np.arange(length)
        after = data[np.minimum(base[:, None] + b[:, None] + col, last)]
        after[col >= (size - b)[:, None]] = 0
        col = np.arange(max(length - TRIGGER, 1))
        back = data[np.clip(base[:, None] + b[:, None] - 1 - col, 0, last)]
        back[col >= b[:, None]] = 0
        (suffixes, left), (parse, right) = _common(back), _common(after)
        for k in range(length - TRIGGER + 1):  # windows that start k bytes before their trigger
            who = np.flatnonzero((b >= k) & (b - w < k))
            if len(who) < 2:
                continue
            name = _classes(suffixes, left, k)[who] * (len(me) + 1) + _classes(parse, right, length - k)[who]
            order = np.argsort(name, kind="stable")
            s = name[order]
            first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
            low = np.repeat(np.minimum.reduceat(least[me][who][order], first), np.diff(np.append(first, len(s))))
            hit = order[low < greatest[me][who][order]]
            low = low[low < greatest[me][who][order]]
            p = who[hit]
            for f, c in zip(found, (me[p], b[p] - k, low)):
                f.append(c)
        start = stop
    return [np.concatenate(f) if f else np.zeros(0, np.int64) for f in found]


def _ask_triggers(buckets: int, length: int) -> Callable:
    def run(batches):
        for number, p, _, _ in _parses(batches, length):
            key, count = p.trigger_keys()
            yield from _messages(number, key, buckets, lambda s: [shrink(_steps(key[s]), count[s])])
    return run


def _shared_triggers(rows: pa.Table) -> pa.Table:
    """For a range of triggers: which of them several slices have."""
    sent = [grow(b, np.uint64, np.uint32) for b in rows.column("head").to_pylist()]
    keys = [np.cumsum(k) for k, _ in sent]
    all_keys = np.concatenate(keys)
    distinct, which, slices = np.unique(all_keys, return_inverse=True, return_counts=True)
    phrases = np.bincount(which, np.concatenate([c for _, c in sent]))
    code = (slices > 1).astype(np.uint8)
    code[phrases > HEAVY] = 2
    code = np.split(code[which], np.cumsum([len(k) for k in keys])[:-1])
    return pa.table([rows.column("slice"), rows.column("bucket"), pa.array([shrink(c) for c in code], pa.binary())], names=["slice", "bucket", "reply"])


def _codes(p: Parse, replies: list[dict]) -> np.ndarray:
    """What a slice was told of its triggers, in their order."""
    return np.concatenate([grow(r["codes"], np.uint8)[0] for r in replies]) if replies else np.zeros(len(p.trigger_at), np.uint8)


def _ask_phrases(buckets: int, length: int) -> Callable:
    def run(batches):
        for number, p, _, replies in _parses(batches, length):
            key, phrase, j, n = p.outgoing(_codes(p, replies))
            start = p.first[p.sample[phrase]] + j
            before = p.before[p.sample[phrase]] - j

            def content(s: slice) -> list:
                at = np.stack([start[s], start[s] + n[s] + length - 1], axis=1).ravel()
                text, _ = gather(at, p.data, np.arange(0, len(at), 2))
                return [shrink(_steps(key[s]), n[s].astype(np.uint8), before[s].astype(np.int8), p.least[phrase[s]], p.greatest[phrase[s]]), zstandard.compress(text.tobytes(), 1)]

            yield from _messages(number, key, buckets, content)
    return run


def _answer_phrases(length: int) -> Callable:
    def run(rows: pa.Table) -> pa.Table:
        sent = [grow(b, np.uint64, np.uint8, np.int8, np.int64, np.int64) for b in rows.column("head").to_pylist()]
        key = np.concatenate([np.cumsum(c[0]) for c in sent])
        n, before, least, greatest = (np.concatenate([c[k] for c in sent]).astype(np.int64) for k in range(1, 5))
        data = np.concatenate([np.frombuffer(zstandard.decompress(b), np.uint8) for b in rows.column("body").to_pylist()])
        size = n + length - 1
        order = np.argsort(key, kind="stable")
        phrase, j, doc = least_documents(key[order], n[order], before[order], least[order], greatest[order], data, (np.cumsum(size) - size)[order], length)
        phrase = order[phrase]
        order = np.lexsort((j, phrase))
        phrase, j, doc = phrase[order], j[order], doc[order]
        # windows in a row with one answer
        new = np.ones(len(phrase), bool)
        new[1:] = (phrase[1:] != phrase[:-1]) | (j[1:] != j[:-1] + 1) | (doc[1:] != doc[:-1])
        run_at = np.flatnonzero(new)
        count = np.diff(np.append(run_at, len(phrase)))
        phrase, j, doc = phrase[run_at], j[run_at], doc[run_at]
        border = np.cumsum([0] + [len(c[0]) for c in sent])
        part = np.searchsorted(phrase, border)
        replies = [shrink((phrase[a:b] - border[k]).astype(np.uint32), j[a:b].astype(np.uint8), count[a:b].astype(np.uint8), doc[a:b])
                   for k, (a, b) in enumerate(zip(part[:-1], part[1:]))]
        return pa.table([rows.column("slice"), rows.column("bucket"), pa.array(replies, pa.binary())], names=["slice", "bucket", "reply"])
    return run


def _removed(p: Parse, replies: list[dict], buckets: int) -> np.ndarray:
    """Which bytes of a slice lie in strings of smaller documents."""
    key, phrase, j0, _ = p.outgoing(_codes(p, [r for r in replies if r["codes"] is not None]))
    bucket = buckets_of(key, buckets)
    count = p.windows[p.sample]
    at = np.cumsum(count) - count
    low = np.repeat(p.least, count)
    for r in replies:
        if r["answers"] is None:
            continue
        k, j, n, doc = grow(r["answers"], np.uint32, np.uint8, np.uint8, np.int64)
        k = k.astype(np.int64) + np.searchsorted(bucket, r["bucket"])
        w = np.repeat(at[phrase[k]] + j0[k] + j, n) + _ranges(n.astype(np.int64))
        low[w] = np.minimum(low[w], np.repeat(doc, n))
    held = (np.minimum.reduceat(low, at) < p.greatest) if len(at) else np.zeros(0, bool)
    who = np.flatnonzero(held[p.phrase])
    n = p.windows[who]
    j = _ranges(n)
    hit = low[np.repeat(at[p.phrase[who]], n) + j] < np.repeat(p.doc[who], n)
    start = (np.repeat(p.first[who], n) + j)[hit]
    cover = np.zeros(len(p.data) + p.length + 1, np.int32)
    cover[start] += 1
    cover[start + p.length] -= 1
    return np.cumsum(cover)[: len(p.data)] > 0


def _cut(buckets: int, length: int) -> Callable:
    def run(batches):
        for _, p, raw, replies in _parses(batches, length):
            gone = _removed(p, replies, buckets)
            begin = gone.copy()
            begin[1:] &= ~gone[:-1]
            inner = p.offsets[:-1][np.diff(p.offsets) > 0]
            begin[inner] = gone[inner]
            sums = [np.concatenate([[0], np.cumsum(m)]) for m in (gone, begin)]
            removed, spans = (s[p.offsets[1:]] - s[p.offsets[:-1]] for s in sums)
            size = np.diff(p.offsets)
            kept = p.data[~gone].tobytes()
            end = np.cumsum(size - removed)
            for a in range(0, len(size), 1000):  # results leave in batches, too
                b = min(a + 1000, len(size))
                yield pa.record_batch(
                    [raw.slice(a, b - a), pa.array(size[a:b]), pa.array(removed[a:b]), pa.array(spans[a:b]),
                     pa.array([kept[e - s : e] for e, s in zip(end[a:b].tolist(), (size - removed)[a:b].tolist())], pa.binary())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: ``id``, ``n_bytes``, ``n_removed``, ``n_spans``
    (runs of removed bytes) and ``kept``, the bytes that remain."""
    if not TRIGGER <= length <= TRIGGER + 127:
        raise ValueError(f"length must be from {TRIGGER} to {TRIGGER + 127}")
    spark = docs.sparkSession
    small_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")  # a row of the slices is about a megabyte
    slices = stored(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(pack, "slice long, bytes long, data binary"), "slices")
    total = slices.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(partitions(spark), -(-total // BUCKET_TEXT))
    answer = "slice long, bucket long, reply binary"
    triggers = slices.mapInArrow(_ask_triggers(buckets, length), "bucket long, slice long, head binary")
    codes = stored(triggers.groupBy("bucket").applyInArrow(_shared_triggers, answer).withColumnRenamed("reply", "codes"), "triggers")
    told = slices.join(codes.groupBy("slice").agg(F.collect_list(F.struct("bucket", "codes")).alias("replies")), "slice", "left")
    phrases = told.mapInArrow(_ask_phrases(buckets, length), "bucket long, slice long, head binary, body binary")
    answers = phrases.groupBy("bucket").applyInArrow(_answer_phrases(length), answer).withColumnRenamed("reply", "answers")
    both = codes.withColumn("answers", F.lit(None).cast("binary")).unionByName(answers.withColumn("codes", F.lit(None).cast("binary")))
    told = slices.join(both.groupBy("slice").agg(F.collect_list(F.struct("bucket", "codes", "answers")).alias("replies")), "slice", "left")
    return told.mapInArrow(_cut(buckets, length), "id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op12_repeats(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
