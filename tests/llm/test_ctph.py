"""Operator 7: neighbours and edited texts by sorting, signatures and edit distance singly."""

import hashlib
import random

from bizlens.llm.ctph import ALPHABET, Hasher, _common, edited, fingerprints, likeness, neighbours, op7_fingerprints
from pyspark.sql import functions as F


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(row[k + 1], new[k]))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 30))) for _ in range(2))
        assert _common(a, b) == lcs(a, b)


def test_signatures_follow_the_content():
    rng = random.Random(1)
    text = " ".join(str(rng.random()) for _ in range(400)).encode()
    h = Hasher()
    whole = h.fingerprint(text)
    block, one, two = whole.split(":")
    assert 32 <= len(one) <= 64 and len(two) <= len(one) and set(one) <= set(ALPHABET.tobytes().decode())
    assert likeness(whole, h.fingerprint(text)) == 1
    assert likeness(whole, h.fingerprint(text[:3000] + b"!!" + text[3000:])) > 0.9  # boundaries find themselves again
    assert likeness(whole, h.fingerprint(b"other " * 2 + bytes(rng.randrange(256) for _ in range(len(text))))) < 0.4
    assert h.fingerprint(b"") == "3::" and likeness("3::", "3::") == 1 and likeness("3:A:A", "96:A:A") == 0
    assert len(h.fingerprint(b"a" * 200_000)) < 200


def test_query(spark, small_dir, texts):
    got = {r["doc_id"]: r for r in op7_fingerprints(spark, small_dir).collect()}
    order = sorted(((i, t or "") for i, t in texts), reverse=True)
    h = Hasher()
    assert len(got) == len(order)
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        changed = t[: len(t) - half] + following[:half]
        r = got[i]
        assert changed == edited(t, following) and r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (h.fingerprint(t.encode()), h.fingerprint(changed.encode()))
        assert r["near_edited"] == likeness(r["fingerprint"], r["edited_fingerprint"]) and r["near_next"] == likeness(r["fingerprint"], h.fingerprint(following.encode()))


def test_odd_rows(odd, none):
    pair = lambda: lambda i, a, b: {"i": i, "a": a, "b": b}
    got = [(r["i"], r["a"], r["b"]) for r in neighbours(odd, pair, "i long, a string, b string").collect()]
    order = sorted(((r["doc_id"], r["text"] or "") for r in odd.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert sorted(got, key=str) == sorted(((i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order)), key=str)
    assert neighbours(none, pair, "i long, a string, b string").count() == 0
    one = none.unionByName(odd.where("doc_id = 6"))
    assert [(r["a"], r["b"]) for r in neighbours(one, pair, "i long, a string, b string").collect()] == [("un deux", "un deux")]
    assert fingerprints(odd).where(F.col("fingerprint").isNull()).count() == 0
