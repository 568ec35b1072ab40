"""Operator 10: phrases against substring search, held-out accuracy."""

import random
import time
import zlib

import pytest
from bizlens.llm import langid
from bizlens.llm.langid import CrossParser, identify, learn, op10_language

SAMPLES = {"en": "the cat sat on the mat and the dog ran off", "fr": "le chat est sur le tapis et le chien court", "xx": "zzz zz"}


def phrases(parser, k, text, sample):
    """Longest phrases found by search in the sample."""
    t, hay = ("".join(map(chr, parser.codes([x])[0].tolist())) for x in (text, sample))
    at = n = 0
    while at < len(t):
        end = at + 1
        while end <= len(t) and t[at:end] in hay:
            end += 1
        at, n = max(at + 1, end - 1), n + 1
    return n


@pytest.mark.parametrize("text", ["the cat ran", "le chien", "Où est le CHAT ?!", "qqq", "", "zzzzzzzz", "the  mat\n\n&& the 12 dog", "ÀÉ"])
def test_phrases(text):
    p = CrossParser(SAMPLES)
    total, _, lettered = p.parse([text, "the", text])
    assert (total[:, 0] == total[:, 2]).all() and lettered[0] == any(c.isalpha() for c in text)
    for k, lang in enumerate(p.langs):
        assert total[k, 0] == phrases(p, k, text, SAMPLES[lang])


def test_stretches_change_nothing(monkeypatch):
    rng = random.Random(5)
    words = "the cat sat on mat and dog ran off le chat est sur tapis un chien court zz zzz q".split()
    texts = ["the cat sat on the mat " * 40, "z" * 777, "zz " * 300, "q" * 500, "x", "", "cat the ", "on the mat and the dog ran" * 30,
             *(" ".join(rng.choices(words, k=rng.randint(1, 200))) for _ in range(30)), "".join(rng.choices("the cat", k=900))]
    parser = CrossParser(SAMPLES)
    whole = parser.parse(texts)[0]
    for stretch in (1, 2, 7, 50, 64, 333):
        monkeypatch.setattr(langid, "STRETCH", stretch)
        assert (parser.parse(texts)[0] == whole).all()
    for k, lang in enumerate(parser.langs):
        assert [phrases(parser, k, t, SAMPLES[lang]) for t in texts] == whole[k].tolist()


def test_many_letters_take_no_room():
    rng = random.Random(6)
    samples = {f"l{k}": "".join(rng.choices([chr(c) for c in range(0x4E00 + 3000 * k, 0x4E00 + 3000 * k + 3000)], k=24_000)) for k in range(4)}
    samples |= {f"m{k}": " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(4000)) for k in range(6)}
    parser = CrossParser(samples)
    assert parser.moves.keys.nbytes + parser.moves.to.nbytes < 60 << 20
    langs = parser.predict([samples["l2"][100:300], samples["m1"][50:400], samples["l0"][:50]])[0]
    assert langs == ["l2", "m1", "l0"]


def test_even_text_takes_linear_time():
    parser, began = CrossParser(SAMPLES), time.perf_counter()
    parser.parse(["zz " * 700_000 + "the cat"])
    assert time.perf_counter() - began < 30


def test_more_labels_than_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGS", 3)
    rows = [(k, f"text of label {k % 5} " * 60, f"l{k % 5}" if k < 40 else "l0") for k in range(50)]
    samples = learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [lang for lang, _ in samples] == ["l0", "l1", "l2"]
    assert all(0 < len(t) <= langid.TRAIN_CHARS for _, t in samples)


def test_query(spark, small_dir, docs):
    want = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = {r["doc_id"]: r for r in op10_language(spark, small_dir).collect()}
    assert set(got) == set(want)
    held = [i for i in got if got[i]["held_out"]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    assert sum(got[i]["lang_pred"] == want[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_odd_rows(odd, none):
    got = identify(odd, learn(odd)).collect()
    assert len(got) == odd.count() and identify(odd, learn(odd)).columns == [*odd.columns, "lang_pred", "score", "bits"]
    for r in got:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
        if r["text"] == "un deux":
            assert r["lang_pred"] == "fr"
    assert identify(none, learn(odd)).count() == 0
    assert {r["lang_pred"] for r in identify(odd, learn(none)).collect()} == {"und"}
