"""Operator 6 against a trie of dictionaries."""

import functools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from bizlens.llm import ppm
from bizlens.llm.ppm import ORDER, blend, op6_ppm_scores, score, train

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


class Plain:
    def __init__(self, texts):
        self.tokens, self.after, self.places = Counter(), defaultdict(Counter), 0
        for t in texts:
            self.tokens.update([*WORD.findall(t.translate(LOWER)), "\n"])
            s = [254] * ORDER + [*t.encode(), 255]
            for k in range(ORDER, len(s)):
                self.places += 1
                for o in range(ORDER + 1):
                    self.after[tuple(s[k - o : k])][s[k]] += 1
        self.total, self.types = sum(self.tokens.values()), len(self.tokens)

    @functools.lru_cache(None)  # noqa: B019
    def symbols(self, ctx):
        lower = self.symbols(ctx[1:]) if ctx else [1 / 256] * 256
        c = self.after.get(ctx)
        if not c or len(ctx) > 2 and sum(c.values()) * ppm.SHARE < self.places:
            return lower
        n, q = sum(c.values()), len(c)
        rest = sum(lower[s] for s in range(256) if s not in c)
        return [c[s] / (n + q) if s in c else q / (n + q) * lower[s] / rest for s in range(256)]

    def score(self, t):
        s = [254] * ORDER + [*t.encode(), 255]
        return sum(math.log10(self.symbols(tuple(s[k - ORDER : k]))[s[k]]) for k in range(ORDER, len(s)))

    def base(self, t):
        w = [*WORD.findall(t.translate(LOWER)), "\n"]
        return len(w), sum(self.tokens[x] > 0 for x in w), sum(math.log10((self.tokens[x] + 0.1) / (self.total + 0.1 * (self.types + 1))) for x in w)


@pytest.mark.parametrize("table", [1 << 21, 50])
def test_query(spark, small_dir, texts, monkeypatch, table):
    monkeypatch.setattr(ppm, "TABLE", table)
    got = {r["doc_id"]: r for r in op6_ppm_scores(spark, small_dir).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in texts}
    plain = Plain([t or "" for i, t in texts if not held[i]])
    assert len(got) == len(texts)
    for i, t in texts:
        r = got[i]
        n, known, base = plain.base(t or "")
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], n, known, plain.total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    for i, t in texts[:20]:
        assert got[i]["score"] == pytest.approx(plain.score(t or ""), rel=1e-5)


@pytest.mark.parametrize("sent, table", [(1 << 16, 1 << 24), (50, 3000), (1, 1)])
def test_rare_contexts_count(spark, small_dir, texts, monkeypatch, sent, table):
    """Against a trie without a least share, whatever is looked up by the worker."""
    monkeypatch.setattr(ppm, "SENT", sent, raising=False)
    monkeypatch.setattr(ppm, "TABLE", table)
    some = spark.createDataFrame([(i, t) for i, t in texts[:60]], "doc_id long, text string")
    plain = Plain([t or "" for _, t in texts[20:60]])
    plain.places = 0  # no share is too small
    got = {r["doc_id"]: r["score"] for r in score(some, train(some.where(some.doc_id.isin([i for i, _ in texts[20:60]])))).collect()}
    for i, t in texts[:40]:
        assert got[i] == pytest.approx(plain.score(t or ""), rel=1e-5)


def test_symbols_of_a_context_share_one():
    rng = np.random.default_rng(1)
    lower = rng.dirichlet(np.ones(256), 50)
    counts = rng.integers(0, 5, (50, 256)) * (rng.random((50, 256)) < 0.1)
    counts[0], counts[1] = 0, 1
    assert np.allclose(blend(counts, lower).sum(axis=1), 1)


def test_odd_rows(odd, none):
    texts = [r["text"] or "" for r in odd.collect()]
    plain = Plain(texts)
    got = sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in score(odd, train(odd)).collect())
    assert got == sorted((n, k, round(b, 6)) for n, k, b in map(plain.base, texts))
    assert score(none, train(odd)).count() == 0
    untaught = score(odd, train(none)).collect()
    assert len(untaught) == odd.count() and all(r["n_known"] == 0 for r in untaught)
