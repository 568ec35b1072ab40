"""Operator 11 against plain conversations and a search over all edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from bizlens.llm import repair as m
from bizlens.llm.repair import SYMBOLS, Grammar, finish, illegal_pairs, op11_repair, product, re_pair, repair


def harmed(rows):
    """(conv, turn, role, text) -> conversations after the damage."""
    out = defaultdict(list)
    s = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        out[conv]
        role, text = s(role), s(text)
        k = zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        role = "user" if k == 4 else role
        out[conv] += [(turn, role, text)] * (2 if k == 3 else 1)
    for rows in out.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def cheapest(rows, every=False):
    """Row by row without matrices; with ``every`` all audits of least cost of
    a state are kept, otherwise the first of them."""
    follow = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    layer = {0: [(0, "", ())]}
    for role, text, fault in rows + [(None, None, None)]:
        reach = defaultdict(list)
        for p, options in layer.items():
            for cost, audit, made in options:
                at = p
                for k in range(3):
                    reach[at].append((cost + 2 * k, audit + "I" * k, made + tuple(("user:", "assistant:")[(i + (p == 2)) % 2] for i in range(k))))
                    at = 3 if at == 2 else 2
        if role is None:
            return min(o for p in (0, 3) for o in reach.get(p, []))
        layer = defaultdict(list)
        for p, options in reach.items():
            for cost, audit, made in options:
                layer[p].append((cost + 3, audit + "D", made))
                if fault in ("blank", "duplicate"):
                    continue
                add = fault == "truncated"
                for r, name in (("u", "user"), ("a", "assistant")):
                    if r in follow[p]:
                        layer[follow[p][r]].append((cost + 2 + add, audit + "R", made + (f"{name}:{text}",)))
                if role[:1] in follow[p]:
                    layer[follow[p][role[:1]]].append((cost + add, audit + "K", made + (f"{role}:{text}",)))
        for p, options in layer.items():
            least = min(options)
            layer[p] = [o for o in options if o[0] == least[0]] if every else [least]


def expected(rows):
    out = []
    for conv, after in harmed(rows).items():
        seen, faults = set(), []
        for _, role, text in after:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, *_ in after if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        who = [r[:1] if r[:1] in ("s", "u", "a") and r else "o" for _, r, _ in after]
        cost, audit, made = cheapest([(r, t, f) for (_, r, t), f in zip(after, faults)])
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(a + b not in ("su", "ua", "au") for a, b in zip(who, who[1:])),
                    cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return sorted([tuple(r) for r in repair(df).collect()], key=repr)


def test_every_short_sequence():
    rng = random.Random(11)
    faults = ["", "truncated", "duplicate"]
    for _ in range(600):
        s = "".join(rng.choice(SYMBOLS) for _ in range(rng.randint(1, 7)))
        g = Grammar([s])
        rows = [(("system", "user", "assistant", "tool")[SYMBOLS.index(c) % 4], "x", faults[SYMBOLS.index(c) // 4]) for c in s]
        cost, audit, _ = cheapest(rows, every=True)
        assert finish(g.solve(0)) == (cost, audit), s


def test_re_pair_restores_the_sequences():
    rng = random.Random(5)
    sequences = ["".join(rng.choice("uaua0U") for _ in range(rng.randint(1, 300))) for _ in range(60)] + ["u" * 101, "u" * 100, "ua" * 64]
    g = Grammar(sequences)
    assert g.rules and sum(map(len, g.short)) < sum(map(len, sequences)) / 2

    def open_(k):
        return SYMBOLS[k] if k < len(SYMBOLS) else "".join(map(open_, g.rules[k - len(SYMBOLS)]))

    assert ["".join(map(open_, s.tolist())) for s in g.short] == sequences
    for k, s in enumerate(sequences):
        plain = product([m.symbol_matrix(SYMBOLS.index(c)) for c in s])
        assert g.solve(k) == plain
    assert re_pair([]) == ([], [])


def test_random_conversations(spark):
    rng = random.Random(2)
    texts = ["Yes.", "No", "Why?", "", " \t", "ok. ", "é!", "a\nb.", None, "Yes. no"]
    rows = []
    for conv in range(120):
        rows += [(conv, rng.choice([t, t, t, t + 3, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "agent"]), rng.choice(texts)) for t in range(rng.randint(1, 9))]
    rows += [(None, 0, "user", "Hi."), (None, None, None, None), (None, 1, "assistant", "Ho."), (None, 1, "assistant", "Ho.")]
    assert run(spark, rows) == expected(rows)


def test_long_conversation_is_cut_and_joined(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(1, k, rng.choice(["user", "assistant"]), rng.choice(["Well.", f"So {k}", f"It is {k}."])) for k in range(3000)]
    rows += [(2, 7, "user", "again.")] * 500 + [(3, None, "user", "again.")] * 40
    assert run(spark, rows) == expected(rows)


def test_batches_of_one_task():
    """The symbols of a conversation beyond a batch leave as several matrices."""
    import pyarrow as pa

    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 4

    old = m.TaskContext, m.BATCH
    m.TaskContext, m.BATCH = Task, 10
    try:
        rows = [(1, "u", "1", 3), (1, "a", "2", 25), (2, "s", "0", 1), (2, "u", "1", 1), (3, "U", "1", 7)]
        batch = pa.record_batch([pa.array(c) for c in zip(*rows)], names=["conv", "symbol", "rest", "n"])
        out = [r for b in m._solve(iter([batch])) for r in b.to_pylist()]
        assert len(out) > 4
        grouped = [(c, [r for r in out if r["conv"] == c]) for c in (1, 2, 3)]
        fold = pa.record_batch([pa.array([c for c, _ in grouped]), pa.array([[{k: v for k, v in r.items() if k != "conv"} for r in rs] for _, rs in grouped])], names=["conv", "parts"])
        got = [tuple(r.values()) for b in m._fold(iter([fold])) for r in b.to_pylist()]
    finally:
        m.TaskContext, m.BATCH = old
    whole = {1: "u11a" + "2" * 24, 2: "su", 3: "U" + "1" * 6}
    want = [(c, illegal_pairs(s), *finish(product([m.symbol_matrix(SYMBOLS.index(x)) for x in s]))) for c, s in whole.items()]
    assert got == want


def test_query_on_smallest_input(spark, small_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted([tuple(r) for r in op11_repair(spark, small_dir).collect()], key=repr)
    assert got == expected(rows)


@pytest.mark.parametrize("empty", [True, False])
def test_extra_columns_and_no_rows(spark, empty):
    rows = [] if empty else [(0, 0, "user", "Hi", 1, "x", "y", 2), (0, 1, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int, conv string, symbol string, first int")
    got = sorted([tuple(r) for r in repair(df).collect()], key=repr)
    assert got == expected([r[:4] for r in rows])


def test_lines(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "So?"), (2, 0, "tool", "x.")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.audit, r.cost, r.lines) for r in repair(df, damage=False, texts=True).collect()}
    assert got == {1: ("KR", 2, ["user:Hi.", "assistant:So?"]), 2: ("D", 3, [])}
    assert np.all([c >= 0 for _, c, _ in got.values()])
