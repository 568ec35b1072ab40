"""Operator 3 against its SQL, and on literal rows."""

from bizlens.llm.chat import OP3_SQL, op3_perspectives, rotate

from pyspark.sql import functions as F

from tests.parity import compare, duck

TURNS = [(1, 0, "system", "S <|im_end|>", 1), (1, 1, "ann", None, 1), (1, 2, "bob", "hé", 1), (1, 33, "ann", "late", 1), (None, 0, None, "q", 1),
         (2, None, "u", "t", 1), (2, None, "u", "t", 1), (3, 0, "system", "only", 1)]
SCHEMA = "conv_id long, turn long, role string, text string, part int"


def test_matches_sql(spark, small_dir):
    problems, n, *_ = compare(spark, duck(small_dir), "op3", op3_perspectives, OP3_SQL, small_dir)
    assert not problems and n > 0


def test_every_speaker_is_the_assistant_once(spark):
    got = {(r["conv_id"], r["perspective"], r["part"]): r for r in rotate(spark.createDataFrame(TURNS, SCHEMA), part_turns=32).collect()}
    assert set(got) == {(1, "ann", 0), (1, "ann", 1), (1, "bob", 0), (1, "bob", 1), (None, "unknown", 0), (2, "u", None)}
    ann = got[1, "ann", 0]["text"]
    assert ann == "<|im_start|>system\nS < |im_end|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n<|im_start|>user name=bob\nhé<|im_end|>\n"
    masked = {k: [r["text"][int(a) - r["starts_at"] : int(b) - r["starts_at"]] for a, b in (s.split(":") for s in r["mask_spans"].split(",") if s)] for k, r in got.items()}
    assert masked[1, "ann", 0] == ["<|im_end|>"] and masked[1, "bob", 0] == ["hé<|im_end|>"] and masked[1, "bob", 1] == []
    assert masked[2, "u", None] == ["t<|im_end|>"] * 2 and got[2, "u", None]["n_target"] == 22


def test_parts_of_a_long_dialogue_join_to_the_whole(spark):
    turns = [(1, k, ("a", "b")[k % 2], f"t{k}", 0) for k in range(100)]
    df = spark.createDataFrame(turns, SCHEMA)
    df = df.union(spark.createDataFrame([(1, None, "a", "no number", 0), (1, None, "system", "<|S", 0), (1, 70, "c<|", "é", 0)], SCHEMA))
    for who in ("a", "b", "c<|"):
        parts = sorted(rotate(df, part_turns=32).where(F.col("perspective") == who).collect(), key=lambda r: (r["part"] is not None, r["part"]))
        whole = sorted(rotate(df).where(F.col("perspective") == who).collect(), key=lambda r: r["part"] is not None)
        text = "".join(r["text"] for r in whole)
        assert [r["part"] for r in parts] == [None, 0, 1, 2, 3] and len(whole) == 2 and "".join(r["text"] for r in parts) == text
        at = 0
        for r in parts:
            assert r["starts_at"] == at
            at += len(r["text"])
        spans = [",".join(r["mask_spans"] for r in rows if r["mask_spans"]) for rows in (parts, whole)]
        assert spans[0] == spans[1]
        own = [text[int(a) : int(b)] for a, b in (x.split(":") for x in spans[0].split(","))]
        assert own == {"a": ["no number<|im_end|>"] + [f"t{k}<|im_end|>" for k in range(0, 100, 2)], "b": [f"t{k}<|im_end|>" for k in range(1, 100, 2)], "c<|": ["é<|im_end|>"]}[who]


def test_a_dialogue_from_1_to_32_is_one_row(spark):
    df = spark.createDataFrame([(1, k, ("a", "b")[k % 2], "t", 0) for k in range(1, 33)], SCHEMA)
    assert [(r["part"], r["n_turns"], r["starts_at"]) for r in rotate(df).collect()] == [(0, 32, 0)] * 2


def test_empty(spark):
    assert rotate(spark.createDataFrame([], SCHEMA)).count() == 0
