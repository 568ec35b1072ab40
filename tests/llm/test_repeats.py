"""Operator 12 against a search of every 50-byte string."""

import random

import numpy as np
import pytest

from bizlens.llm import repeats
from bizlens.llm.repeats import HEAVY, TRIGGER, Parse, grow, op12_repeats, remove_repeats, shrink
from pyspark.sql import functions as F


def plain(rows, length=50):
    """(id, text) -> rows (id, n_bytes, n_removed, n_spans, kept)."""
    first = {}
    rows = [(i, (t or "").encode()) for i, t in rows]
    for i, b in rows:
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            if i is not None and (w not in first or i < first[w]):
                first[w] = i
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            j = first.get(b[k : k + length])
            if j is not None and (i is None or j < i):
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted([(r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(df, **kw).collect()], key=repr)


def test_smallest_input(spark, texts):
    assert run(spark, texts) == plain(texts)


def test_made_cases(spark):
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    shared = [word(n) for n in (49, 50, 51, 120, 700)]
    rows = [(5, word(30) + shared[0] + word(3)), (4, shared[0]), (9, shared[1]), (8, shared[1]), (7, word(9) + shared[2] + shared[1]), (20, "-" * 300), (21, "x" + "-" * 120), (22, "-" * 49)]
    rows += [(100 + k, word(rng.randint(0, 80)) + shared[3 + k % 2] + word(rng.randint(0, 80))) for k in range(60)]
    rows += [(300, "abab" * 50), (301, "baba" * 50), (302, "\0" * 130), (303, "\0" * 60 + "a"), (304, "ab\0" + "\0" * 50)]
    rows += [(400 + k, shared[4][k : 400 + 2 * k] + shared[3]) for k in range(0, 60, 7)]
    rows += [(1, None), (2, ""), (None, shared[4]), (None, shared[4]), (100, shared[4]), (100, shared[4])]
    rng.shuffle(rows)
    assert run(spark, rows) == plain(rows)


@pytest.mark.parametrize("length", [20, 33, 70])
def test_other_lengths(spark, length):
    rng = random.Random(length)
    parts = ["".join(rng.choice("ab") for _ in range(n)) for n in (15, 30, 60, 90)]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))) for k in range(80)]
    assert run(spark, rows, length=length) == plain(rows, length)


def test_long_text(spark):
    rng = random.Random(3)
    passage = bytes(rng.randrange(97, 123) for _ in range(200)).decode()
    long = "".join(rng.choice("qrstuvwxyz") for _ in range(repeats.BLOCK - 100)) + passage + "".join(rng.choice("qrstuvwxyz") for _ in range(1000))
    rows = [(3, long), (1, "zz" + passage), (2, long[500:900])]
    assert run(spark, rows) == plain(rows)


def test_heavy_triggers(spark):
    """A ruling in more distinct phrases than one task takes is dealt by windows."""
    rng = random.Random(8)
    marks = ["".join(rng.choice("=+*~") for _ in range(TRIGGER)) for _ in range(2000)]
    data = np.frombuffer("".join(m + "." * 40 for m in marks).encode(), np.uint8)
    p = Parse(data, np.array([0, len(data)]), np.array([1]))
    t = p.first + p.before
    low = {bytes(data[x : x + TRIGGER]): int(k) for x, k in zip(t, p.key[p.phrase])}
    mark = min((v, k) for k, v in low.items() if k.decode() in set(marks))[1].decode()
    rows = [(k, f"{rng.random():.15f}"[2:] * 2 + mark + f"{rng.randrange(40):040d}") for k in range(HEAVY + 1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    body = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    p = Parse(body, np.cumsum([0] + [len(t) for _, t in rows]), np.arange(len(rows)))
    assert np.diff(np.append(p.trigger_at, len(p.key))).max() > HEAVY
    got = sorted((r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(df).collect())
    assert got == sorted(plain(rows)) and sum(r[2] for r in got)


def test_phrases_cover_every_window_once():
    rng = random.Random(1)
    for _ in range(30):
        texts = ["".join(rng.choice("ab\n") for _ in range(rng.choice([0, 10, 49, 50, 51, 400]))) for _ in range(8)]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        p = Parse(data, np.cumsum([0] + [len(t) for t in texts]), np.arange(8))
        starts = [int(a) + k for a, n in zip(p.first, p.windows) for k in range(n)]
        assert sorted(starts) == [o + k for o, t in zip(p.offsets, texts) for k in range(len(t) - 49)]
        assert all(0 <= b <= 50 - TRIGGER for b in p.before) and all(b - n + 1 >= 0 for b, n in zip(p.before, p.windows))


def test_columns_round_trip():
    a, b = np.array([1, 2, 1 << 47], np.uint64), np.array([3, 0, 255], np.uint8)
    assert all((x == y).all() for x, y in zip(grow(shrink(a, b), np.uint64, np.uint8), (a, b)))
    assert all(len(x) == 0 for x in grow(shrink(a[:0], b[:0]), np.uint64, np.uint8))


def test_odd_rows_and_no_rows(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = sorted([(r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(odd).collect()], key=repr)
    assert got == plain(rows)
    assert remove_repeats(none).count() == 0


def test_query(spark, small_dir, texts):
    import hashlib

    got = sorted(tuple(r) for r in op12_repeats(spark, small_dir).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == sorted((i, n, m, s, hashlib.sha256(k).hexdigest()) for i, n, m, s, k in plain(texts))
