"""Operator 9 against tiktoken, and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers as vocabularies
import pytest
import tiktoken
from bizlens.llm.bpe import codec, decode, digests, encode, op9_byte_bpe, read_ranks
from hypothesis import given, settings, strategies as st

PATH, PATTERN = vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})


def same(plain, texts):
    c = codec(PATH, PATTERN)
    ids, counts = c.encode(texts)
    for text, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert part.tolist() == plain.encode_ordinary(text)
        assert c.decode(part)[0].tobytes() == text.encode()


def test_odd_texts(plain):
    rng = random.Random(1)
    same(plain, ["".join(rng.choice("ab 's'tll\n\t  \u0085\x1c\x1f  éß😀你á.,!?<|endoftext|>0123ſ ") for _ in range(rng.randint(0, 60))) for _ in range(1500)])
    same(plain, ["", " ", "  ", "\n ", " \n a", "a" * 3000, "İstanbul, ǅ."])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=4))
def test_any_text(plain, texts):
    same(plain, texts)


def test_spans_share_split_characters():
    c = codec(PATH, PATTERN)
    text = "é😀 你a"
    spans = c.char_spans(c.encode([text])[0])
    assert spans[0, 0] == 0 and spans[-1, 1] == len(text) and (spans[:, 0] <= spans[:, 1]).all()
    ids = c.encode([text])[0]
    for (a, b), i in zip(spans, ids, strict=True):
        part = c.decode(np.array([i]))[0].tobytes()
        assert part in text[a : max(b, a + 1)].encode()


def test_query(spark, small_dir, texts, plain):
    got = {r["doc_id"]: r for r in op9_byte_bpe(spark, small_dir).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        ids = plain.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_odd_rows(odd, none):
    back = decode(encode(odd, PATH, PATTERN), PATH, PATTERN).select("decoded").collect()
    assert sorted(bytes(r["decoded"]) for r in back) == sorted((r["text"] or "").encode() for r in odd.collect())
    assert digests(odd, PATH, PATTERN).count() == odd.count()
    assert encode(none, PATH, PATTERN).count() == digests(none, PATH, PATTERN).count() == 0
