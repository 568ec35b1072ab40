"""Operator 8 against all pairs."""

import math

import numpy as np
import pytest
from bizlens.llm.components import components
from bizlens.llm.itq import BITS, TABLES, learn_rotations, learn_tables, near_duplicates, op8_embedding_duplicates


def plain(rows, least=0.93):
    """Links and components by comparing all pairs."""
    x = [None if v is None or not v or any(c is None or not math.isfinite(c) for c in v) or not any(v) else np.array(v) / np.linalg.norm(v) for _, v, _ in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if x[a] is not None and x[b] is not None and len(x[a]) == len(x[b]) and rows[a][2] is not None and rows[a][2] == rows[b][2] and x[a] @ x[b] >= least:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least_id = {}
    for k, (i, _, _) in enumerate(rows):
        least_id[find(k)] = min(i, least_id.get(find(k), i))
    return sorted((i, links[k], least_id[find(k)], least_id[find(k)] == i) for k, (i, _, _) in enumerate(rows))


def got(df):
    return sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect())


SCHEMA = "vec_id long, embedding array<float>, label int, n long"


@pytest.mark.parametrize("block", [3, 1024])
def test_clusters_copies_and_unusable_vectors(spark, block):
    rng = np.random.default_rng(2)
    rows, centres = [], rng.standard_normal((6, 16))
    for i in range(90):
        v = centres[i % 6] + rng.standard_normal(16) * rng.choice([0.05, 0.25])
        rows.append((i, [float(np.float32(c)) for c in v], int(i % 3), 1))
    rows += [(200 + k, rows[5][1], 2, 1) for k in range(10)]  # exact copies
    rows += [(300, None, 1, 1), (301, [0.0] * 16, 1, 1), (302, [1.0, None] + [0.0] * 14, 1, 1), (303, [float("nan")] * 16, 1, 1), (304, [], 1, 1),
             (305, rows[0][1], None, 1), (306, rows[0][1][:8], 0, 1), (307, rows[0][1][:8], 0, 1), (308, [float("inf")] * 16, 1, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain([(r[0], r[1], r[2]) for r in rows])
    have = got(near_duplicates(df, block=block))
    assert [h[0] for h in have] == [w[0] for w in want]
    assert all(h[1] <= w[1] for h, w in zip(have, want, strict=True))
    assert sum(h[1] for h in have) >= 0.9 * sum(w[1] for w in want)
    whole = {w[0]: w for w in want if w[0] >= 200}
    assert all(h == whole[h[0]] for h in have if h[0] >= 300)


def test_recall_beside_many_copies(spark):
    """A third of the rows are copies of one vector, in the midst of its near copies."""
    rng = np.random.default_rng(3)
    hot = rng.standard_normal(64) / 8
    vectors = rng.standard_normal((1400, 64)) / 8
    vectors[:200] = hot + 0.2 * vectors[:200]  # about 0.98 to the hot one
    vectors = [[float(np.float32(c)) for c in v] for v in [hot, *vectors]]
    rows = [(k, v, 1, 1) for k, v in enumerate(vectors)] + [(10_000 + k, vectors[0], 1, 1) for k in range(700)]
    want = {r[0]: r[1] for r in plain([(k, v, 1) for k, v, *_ in rows[: len(vectors)]])}
    have = {r[0]: r[1] for r in got(near_duplicates(spark.createDataFrame(rows, SCHEMA)))}
    assert have[0] - 700 >= 0.9 * want[0] > 100  # pairs of distinct vectors
    linked = [k for k in range(1, len(vectors)) if have[k] > 700]  # those that meet the hot vector count its copies
    assert len(linked) >= 0.9 * want[0]
    among = sum(have[k] - (701 if have[k] > 700 else 0) for k in range(1, len(vectors)))
    assert among >= 0.9 * (sum(want.values()) - 2 * want[0])


def result(spark, rows, kind="float"):
    """Among vectors of another label, as the cuts need some to fall between."""
    more = np.random.default_rng(4).standard_normal((300, 16)) / 4
    df = spark.createDataFrame([(*r, 1) for r in rows] + [(1000 + k, [float(c) for c in v], 9, 1) for k, v in enumerate(more)], SCHEMA.replace("float", kind))
    out = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect()]
    return sorted([r for r in out if r[0] is None or r[0] < 1000], key=repr)


def test_one_id_in_two_labels_joins_nothing(spark):
    a, b = [1.0] + [0.0] * 15, [0.0, 1.0] + [0.0] * 14
    near_a, near_b = [1.0, 0.1] + [0.0] * 14, [0.1, 1.0] + [0.0] * 14
    have = result(spark, [(5, a, 1), (7, near_a, 1), (5, b, 2), (3, near_b, 2)])
    assert have == sorted([(5, 1, 5, True), (7, 1, 5, False), (5, 1, 3, False), (3, 1, 3, True)], key=repr)


def test_one_id_with_two_vectors_counts_each(spark):
    a, b = [1.0] + [0.0] * 15, [0.0, 1.0] + [0.0] * 14
    near_a, near_b = [1.0, 0.1] + [0.0] * 14, [0.1, 1.0] + [0.0] * 14
    have = result(spark, [(5, a, 1), (7, near_a, 1), (5, b, 1), (9, near_b, 1)])
    assert have == sorted([(5, 1, 5, True), (7, 1, 5, False), (5, 1, 5, True), (9, 1, 5, False)], key=repr)


def test_rows_without_id_keep_their_links(spark):
    a, near = [1.0] + [0.0] * 15, [1.0, 0.1] + [0.0] * 14
    other = [0.0] * 15 + [1.0]
    have = result(spark, [(None, a, 1), (2, near, 1), (None, other, 1), (None, None, 1)])
    assert have == sorted([(None, 1, 2, False), (2, 1, 2, True), (None, 0, None, True), (None, 0, None, True)], key=repr)


@pytest.mark.parametrize("size", [1e200, 1e-200, 1e-310, 1.0])
def test_magnitudes_play_no_part(spark, size):
    a = [size * c for c in [1.0, -2.0, 3.0, 0.5] * 4]
    have = result(spark, [(1, a, 1), (2, [2 * c for c in a], 1), (3, [-c for c in a], 1)], "double")
    assert have == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_query_recall(spark, small_dir):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    want, have = plain(rows), got(op8_embedding_duplicates(spark, small_dir))
    assert len(have) == len(want) and sum(h[1] for h in have) >= 0.9 * sum(w[1] for w in want)
    assert all(h[1] <= w[1] for h, w in zip(have, want, strict=True))


@pytest.mark.parametrize("n", [600, 6000])
def test_recall_at_two_sizes(spark, n):
    """Near copies down to the least cosine, in one label."""
    rng = np.random.default_rng(n)
    x = rng.standard_normal((n, 32))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    half = n // 2
    away = rng.standard_normal((half, 32)) / np.sqrt(32)
    x[half:] = x[:half] + away * rng.uniform(0.1, 0.42, (half, 1))
    x = x.astype(np.float32).astype(float)
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    want = (unit @ unit.T >= 0.93).sum() - n
    df = spark.createDataFrame([(k, [float(c) for c in v], 1, 1) for k, v in enumerate(x)], SCHEMA)
    have = got(near_duplicates(df))
    assert want > 0.5 * n and 0.95 * want <= sum(h[1] for h in have) <= want


def test_strangers_met_do_not_grow_with_the_rows():
    rng = np.random.default_rng(11)
    met = []
    for n in (1000, 5000, 20_000):
        x = rng.standard_normal((n, 32))
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        bits = max(BITS, (n - 1).bit_length() + 2)
        w, cut = learn_tables(x, bits, 0.93)
        tables = w.shape[1] // bits
        assert tables >= TABLES
        keys = (x @ w >= cut).reshape(n, tables, bits) @ (1 << np.arange(bits))
        pairs = sum(int((c * (c - 1) // 2).sum()) for c in (np.unique(keys[:, t], return_counts=True)[1] for t in range(tables)))
        met.append(pairs / n)
    assert met[1] <= 1.5 * met[0] and met[2] <= 1.5 * met[1], met


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert got(near_duplicates(spark.createDataFrame([(1, None, 1, 1)], SCHEMA))) == [(1, 0, 1, True)]


def test_rotations_give_balanced_bits():
    x = np.random.default_rng(1).standard_normal((500, 16)) * np.linspace(3, 0.2, 16)
    w, cut = learn_rotations(x, 40)
    assert w.shape == (16, 40) and abs(((x @ w) >= cut).mean(axis=0) - 0.5).max() < 0.01
    assert np.allclose(w[:, :16].T @ w[:, :16], np.eye(16))


def test_components(spark):
    rng = np.random.default_rng(7)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, (150, 2))] + [(k, k + 1) for k in range(300, 340)] + [(1, None), (5, 5)]
    root = {}

    def find(k):
        root.setdefault(k, k)
        while root[k] != k:
            k = root[k]
        return k

    for a, b in edges:
        if b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {k: find(k) for k in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
