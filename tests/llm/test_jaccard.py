"""Operator 2 against all pairs."""

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from bizlens.llm import jaccard
from bizlens.llm.jaccard import CountTree, jaccard_components, needed, op2_jaccard, point

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def plain(texts, k=4, percent=85):
    """Sizes and components by comparing all pairs; rows by position."""
    sets = []
    for _, t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and find(a) != find(b) and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for k_, (i, _) in enumerate(texts):
        groups[find(k_)].append(i)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((i, len(s), least[find(k_)]) for k_, ((i, _), s) in enumerate(zip(texts, sets, strict=True))), key=str)


def rows(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def test_whole_table(spark, small_dir, texts):
    assert rows(op2_jaccard(spark, small_dir)) == plain(texts)


@pytest.mark.parametrize("block, levels", [(2, jaccard.LEVELS), (2048, jaccard.LEVELS), (2048, ((50, 8), (58, 16), (1 << 62, 256)))])
def test_near_copies_in_blocks_of_any_size(spark, monkeypatch, block, levels):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "LEVELS", levels)
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for i in range(60):
        words = list(base)
        for at in rng.choice(60, rng.integers(0, 4), replace=False):
            words[at] = f"x{i}{at}"
        texts.append((i, " ".join(words)))
    texts += [(100 + i, f"{' '.join(base[:20])} {' '.join(f'u{i}-{k}' for k in range(40))}") for i in range(20)]  # share a passage only
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(jaccard_components(df)) == plain(texts)
    assert rows(jaccard_components(df, shingle=5, percent=80)) == plain(texts, 5, 80)


def test_odd_rows(odd, none):
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert rows(jaccard_components(odd)) == plain(texts)
    assert jaccard_components(none).count() == 0


def test_tree_loses_nothing():
    rng = np.random.default_rng(1)
    sets = [rng.choice(400, rng.integers(20, 60), replace=False).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(300)]
    sets += [np.concatenate([s[:-2], s[:1] + np.uint64(1)]) for s in sets[:80]]
    size = np.array([len(s) for s in sets])
    tree = CountTree(np.stack([point(s, 64) for s in sets]), size, 85)
    for a in range(0, len(sets), 7):
        linked = [b for b, s in enumerate(sets) if len(np.intersect1d(sets[a], s)) >= needed(size[a], size[b], 85)]
        assert set(linked) <= set(tree.search(a).tolist())


def test_points_of_finer_levels_fold_and_full_counts_bound_nothing():
    s = np.arange(4000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    fine = jaccard.packed_point(s)
    assert len(fine) == 256 and (jaccard.points_at([fine], 64)[0] == point(s, 64)).all()
    same = np.arange(400, dtype=np.uint64)  # all in the first group
    assert jaccard.points_at([jaccard.packed_point(same)], 64)[0, 0] >= 400


def test_families_split_by_shingles(spark, monkeypatch, texts, docs):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 300)
    assert rows(jaccard_components(docs)) == plain(texts)


def test_rows_without_id_meet_their_own_classes_only(spark, monkeypatch):
    """300 rows without an id in 100 families: as many texts are read again, not their product."""
    seen = []
    blocks = jaccard._blocks

    def counted(df, *rest):
        if "shingles" in df.columns:
            seen.append(df.count())
        return blocks(df, *rest)

    monkeypatch.setattr(jaccard, "_blocks", counted)
    texts = [(None, " ".join(f"w{f}x{k}" for k in range(60)) + end) for f in range(100) for end in ("", " tail", " other tail")] + [(4, "w0x1 " * 9), (4, "one two three four five")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(jaccard_components(df)) == plain(texts)
    assert seen and seen[0] <= 310


def test_sets_that_share_a_key_by_chance_are_not_read_again(spark, monkeypatch):
    """40 documents of about 1450 shingles share a passage of 30 words; two others are near copies."""
    seen = []
    blocks = jaccard._blocks

    def counted(df, *rest):
        if "shingles" in df.columns:
            seen.append(df.count())
        return blocks(df, *rest)

    monkeypatch.setattr(jaccard, "_blocks", counted)
    monkeypatch.setattr(jaccard, "SAMPLE", 1)
    shared = " ".join(f"s{k}" for k in range(30))
    texts = [(i, f"{shared} {' '.join(f'u{i}-{k}' for k in range(1440 + i))}") for i in range(40)]
    texts.append((50, texts[7][1] + " end"))
    assert rows(jaccard_components(spark.createDataFrame(texts, "doc_id long, text string"), shingle=5, percent=80)) == plain(texts, 5, 80)
    assert seen == [2]


@pytest.mark.parametrize("crowd", [2, 4, 8])
def test_copies_of_any_size_with_keys_of_few_and_of_many(spark, monkeypatch, crowd):
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    monkeypatch.setattr(jaccard, "MEET_ROWS", 40)
    monkeypatch.setattr(jaccard, "SAMPLE", 1)
    rng = np.random.default_rng(crowd)
    texts = []
    for f in range(12):
        base = [f"w{f}x{k}" for k in range(40 + 10 * f)]
        for i in range(f + 1):
            words = base[int(rng.integers(0, 1 + len(base) // 6)) :]
            for at in rng.choice(len(words), rng.integers(0, 3), replace=False):
                words[at] = f"x{f}-{i}-{at}"
            texts.append((100 * f + i, " ".join(words)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert rows(jaccard_components(df, shingle=3)) == plain(texts, 3)
    assert rows(jaccard_components(df, shingle=2, percent=70)) == plain(texts, 2, 70)


@pytest.mark.parametrize("most", [4, 16, 1 << 16])
def test_every_pair_of_a_key_is_listed_or_its_classes_are(monkeypatch, most):
    monkeypatch.setattr(jaccard, "MEET_ROWS", most)
    rng = np.random.default_rng(2)
    many = [1, 2, 3, 1, 8, 9, 30, 1, 12, 200, 2, 1]
    key = np.repeat(np.arange(len(many)), many)
    ids, size = rng.permutation(len(key)), np.where(key == 8, 4 ** np.minimum(np.arange(len(key)) % 12, 9), rng.integers(90, 130, len(key)))
    batches = [pa.RecordBatch.from_arrays([pa.array(c[a : a + 7]) for c in (key, ids, size)], ["key", "class", "n"]) for a in range(0, len(key), 7)]
    got = [r for b in jaccard._meetings(85)(iter(batches)) for r in b.to_pylist()]
    crowded = defaultdict(set)
    for r in got:
        if r["key"] is not None:
            crowded[r["key"]].add(r["a"])
    assert all(crowded[k] == set(ids[key == k].tolist()) for k in crowded)
    assert set(crowded) <= {5, 6, 8, 9} and 9 in crowded and (most < 1 << 16 or 8 not in crowded)
    want = []
    for k in set(range(len(many))) - set(crowded):
        at = np.flatnonzero(key == k)
        want += [(*sorted((int(ids[x]), int(ids[y]))), int(jaccard.least_met(size[x], size[y], 85))) for x in at for y in at if x < y and 100 * min(size[x], size[y]) >= 85 * max(size[x], size[y])]
    assert sorted((r["a"], r["b"], r["need"]) for r in got if r["key"] is None) == sorted(want)


def test_linked_sets_share_as_many_first_shingles():
    rng = np.random.default_rng(5)
    for percent in (50, 80, 85, 100):
        for _ in range(300):
            n = int(rng.integers(1, 40))
            a = rng.choice(60, n, replace=False)
            b = np.unique(np.concatenate([a[int(rng.integers(0, 1 + n // 4)) :], rng.integers(0, 60, int(rng.integers(0, 1 + n // 3)))]))
            first = [set(np.sort(s)[: len(s) - -(-percent * len(s) // 100) + 1].tolist()) for s in (a, b)]
            if len(b) and 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)):
                assert len(first[0] & first[1]) >= jaccard.least_met(len(a), len(b), percent) >= 1


def test_larger_sets_meet_at_their_own_level():
    size = np.array([90, 100, 110, 112])
    tree = CountTree(np.full((4, 8), 20), size, 80)
    assert sorted(jaccard.forest(tree, top=100)[0].tolist()) == [1, 2, 3]
    tree = CountTree(np.full((2, 8), 20), size[2:], 80)
    assert not len(jaccard.forest(tree, top=100)[0])
