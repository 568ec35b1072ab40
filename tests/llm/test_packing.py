"""Operator 1: the plan on counts against placing items singly, and the packed ids."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as vocabularies
import pytest
from bizlens.llm import packing
from bizlens.llm.packing import Limits, op1_packing, pack_documents, place, plan_packing

PATH = vocabularies.path("word_bpe_49k.json")


def singly(lengths, limits, rule, w):
    """Residuals after vector best fit, item by item."""
    room, bins = limits.vector(), []
    for n in sorted(lengths, reverse=True):
        need = np.array([n, 1, n * n])
        open_bins = [k for k, b in enumerate(bins) if (b >= need).all()]
        if open_bins:
            def cost(k):
                share, own = bins[k] / room, need / room
                return (w * share * own).sum() if rule == "dot" else (w * (share - own) ** 2).sum()
            k = min(open_bins, key=cost)
        else:
            bins.append(np.array([limits.tokens, limits.documents, limits.attention]))
            k = -1
        bins[k] = bins[k] - need
    return sorted(map(tuple, bins))


@pytest.mark.parametrize("rule", ["dot", "norm"])
@pytest.mark.parametrize("limits", [Limits(50, 50, 2500), Limits(50, 4, 2500), Limits(50, 10, 800), Limits(64, 3, 1500)])
def test_plan_is_best_fit_under_every_constraint(rule, limits):
    rng = random.Random(5)
    for _ in range(25):
        most = min(limits.tokens, int(limits.attention**0.5))
        lengths = [rng.randint(1, rng.choice([5, most])) for _ in range(rng.randint(1, 90))]
        w = np.array([1.0, rng.choice([0.2, 1.0]), 0.5])
        counts, rank, ranks = Counter(lengths), Counter(), []
        for n in lengths:
            ranks.append(rank[n])
            rank[n] += 1
        plan = plan_packing(np.array(list(counts)), np.array(list(counts.values())), limits, rule, tuple(w))
        got = defaultdict(list)
        for n, b, o in zip(lengths, *place(plan, np.array(lengths), np.array(ranks)), strict=True):
            got[b].append((o, n))
        left = []
        for items in got.values():
            end = 0
            for offset, n in sorted(items):
                assert offset == end
                end += n
            left.append((limits.tokens - end, limits.documents - len(items), limits.attention - sum(n * n for _, n in items)))
        assert len(got) == plan.bins and sorted(left) == singly(lengths, limits, rule, w)


def test_lengths_that_fit_no_bin_are_refused():
    with pytest.raises(ValueError):
        plan_packing(np.array([9]), np.array([1]), Limits(8, 8, 64))


def check(rows, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    want = Counter()
    for i, text in texts:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for p, lo in enumerate(range(0, len(ids), 4096)):
            part = ids[lo : lo + 4096]
            want[i, p, lo, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in bins.values():
        end = 0
        for offset, n in sorted(items):
            assert offset == end
            end += n
        assert end <= 4096
    return len(bins), sum(k[3] * n for k, n in want.items())


def test_whole_table(spark, small_dir, texts):
    bins, tokens = check(op1_packing(spark, small_dir).collect(), texts)
    assert bins <= -(-tokens // 4096) + 1


def test_odd_rows(odd, none):
    check(pack_documents(odd, PATH).collect(), [(r["doc_id"], r["text"]) for r in odd.collect()])
    assert pack_documents(none, PATH).count() == 0


def test_tasks_number_their_items_apart(docs, texts):
    check(pack_documents(docs.repartition(7), PATH).collect(), texts)


def test_library_gets_each_word_once():
    cache = packing._cache(PATH)
    cache.ids([["hello", "hello,", "world"]])
    n = len(cache.index)
    cache.ids([["world", "hello"]])
    assert len(cache.index) == n
