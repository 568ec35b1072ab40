"""Operator 13 against plain counting, and against its SQL."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from bizlens.llm import collocations as m
from bizlens.llm.collocations import BURST, OP13_SQL, HatTrie, _runs, collocations, merged, op13_collocations


def plain(rows, least=10, absorb=50, top=2000):
    """(text, lang) -> rows of the result."""
    f, n = defaultdict(Counter), Counter()
    lower = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\v\f\r]", (text or "").translate(lower)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for size in (1, 2, 3):
                f[lang].update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        best = []
        for p, a in counts.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(100 * b >= absorb * a for q, b in counts.items() if len(q) == 3 and b >= least and (q[:2] == p or q[1:] == p)):
                continue
            cuts = [(Fraction(1000000 * a * a, counts[p[:k]] * counts[p[k:]]).__floor__(), k) for k in range(1, len(p))]
            score, k = min(cuts)
            best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def run(spark, rows, **kw):
    return sorted(tuple(r) for r in collocations(spark.createDataFrame(rows, "text string, lang string"), **kw).collect())


def test_small_vocabulary(spark):
    rng = random.Random(13)
    words = ["a", "b", "c", "É", "éa", "Na na", "x-y", "0", "\0", "Z" * 300]
    seps = [" ", "  ", "\t", ". ", ",", ";", ":", "!", "?", "\n", "\v", "\f", "\r", " ", "\x1f"]
    rows = [("".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(0, 60))), rng.choice(["en", "fr", None, "und", ""])) for _ in range(150)]
    rows += rows[:20] + [(None, "en"), ("", "xx"), (None, None), (" . , \t", "yy")]
    for kw in ({}, {"min_count": 2, "absorb": 80, "top": 25}):
        assert run(spark, rows, **kw) == plain(rows, kw.get("min_count", 10), kw.get("absorb", 50), kw.get("top", 2000))


def test_overlaps_and_ties(spark):
    rows = [("ha ha ha ha ha ha ha ha ha ha ha ha", "en"), ("Ha HA ha", "en"), ("new york city. " * 12 + "new york times. " * 11 + "york", "en"), ("p q. " * 10, "fr"), ("r s. " * 10, "fr")]
    assert run(spark, rows) == plain(rows)


def test_smallest_input_and_sql(spark, small_dir, docs):
    got = sorted(tuple(r) for r in op13_collocations(spark, small_dir).collect())
    assert got == plain([(r.text, r.lang) for r in docs.select("text", "lang").collect()])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small_dir}/documents.parquet'")
    assert got == sorted(con.execute(OP13_SQL).fetchall())


@pytest.mark.parametrize("share", [1, 3])
def test_trie_spills_and_bursts(monkeypatch, share):
    """Spilled runs, merged, give the counts whatever the moment of the spills."""
    rng = random.Random(share)
    vocabulary = [f"w{k}" for k in range(700)]
    texts = [" ".join(rng.choice(vocabulary) if rng.random() < 0.6 else "the" for _ in range(4000)) + ". the end" for _ in range(12)]
    monkeypatch.setattr(m, "BURST", 300)
    trie, batches = HatTrie(), []
    for k, t in enumerate(texts):
        trie.insert(["en"], np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))
        assert trie.entries == sum(len(c) for node in trie.root for c in (node if isinstance(node, list) else [node]))
        if k == 2:
            assert any(isinstance(node, list) for node in trie.root)  # the frequent word's container
        if k % share == 0:
            before = trie.entries
            batches.append(_runs(trie, *trie.spill(k % 2 == 0), 4))
            assert trie.entries <= before // 2
    batches.append(_runs(trie, *trie.spill(True), 4))
    assert not trie.entries and BURST > 300
    got, words = Counter(), 0
    rows = [r for b in batches for r in b.to_pylist()]
    for part in range(4):
        mine = [(r["n"], r["words"], r["run"]) for r in rows if r["part"] == part]
        found, n = merged(mine, 1)
        words += n
        for *w, f in found:
            got[tuple(x for x in w if x)] += f
    want = Counter()
    for t in texts:
        for piece in t.split("."):
            w = piece.split()
            for size in (1, 2, 3):
                want.update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    assert got == want and words == sum(f for p, f in want.items() if len(p) == 1)


def test_wide_products(spark):
    from bizlens.llm.collocations import _score
    from pyspark.sql import functions as F

    rows = [(10**12, 10**12 + 7, 3 * 10**12), (10, 10, 10), (3_000_000_000, 5_000_000_001, 4_000_000_003)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select(_score(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert [r[0] for r in got] == [1000000 * a * a // (left * right) for a, left, right in rows]


def test_odd_rows_and_no_rows(spark, odd, none):
    got = sorted(tuple(r) for r in collocations(odd).collect())
    assert got == plain([(r.text, r.lang) for r in odd.select("text", "lang").collect()])
    assert collocations(none).count() == 0
