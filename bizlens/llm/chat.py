"""Operator 3: multi-party perspective rotation of dialogues (built-in functions only).

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and all others as named users; turns of a system role
stay system turns in every rendering and take no perspective of their own. A
turn is ``<|im_start|>assistant``, ``<|im_start|>user name=NAME`` or
``<|im_start|>system``, a line break, the text, ``<|im_end|>`` and a line
break. The mask holds the spans to learn from: the assistant's texts with their
end mark, as code points of the rendered text.

A dialogue of up to ``PART_TURNS`` turn numbers, counted from its first one, is
one text a perspective. A longer one is rendered in parts of so many numbers, in
order, so a conversation of any length is spread over tasks; their texts put
together are the whole rendering, ``starts_at`` says where in it a part begins
and spans are places in the whole. Where a part begins follows from counts alone
(the sizes of all turns, and how many are the perspective's own), so texts are
gathered and shuffled once.

Defined results: a null text is an empty turn; a null role is the speaker
``unknown``; turns without a number form a part of their own (null), the first
one; rows of null conversation form one conversation; turns of equal number are ordered by
role and text, and repeated rows are turns of their own; marks within a text
or a name are broken up (``< |``); a conversation of system turns only has no
rendering; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

PART_TURNS = 4096
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _places(rows: DataFrame, system_roles: tuple[str, ...]) -> DataFrame:
    """Where each part (``of``, ``at_part``) begins in each ``perspective``."""
    system = F.col("role").isin(*system_roles)
    named = F.length(F.lit(BEGIN + "user name=\n")) + F.length(_plain(F.col("role")))
    size = F.when(system, len(BEGIN + "system\n")).otherwise(named) + F.length(_plain(F.col("text"))) + len(END) + 1
    counts = rows.groupBy("conv", "part", "role").agg(F.sum(size).alias("size"), F.count("*").alias("n"))
    parts = counts.groupBy("conv", "part").agg(F.sum("size").alias("size"))
    spoken = counts.filter(~system).select(F.col("conv").alias("conv2"), F.col("part").alias("part2"), "role", (F.col("n") * (named - len(BEGIN + "assistant\n"))).alias("less"))
    speakers = spoken.select(F.col("conv2").alias("of"), F.col("role").alias("perspective")).distinct()
    every = parts.join(speakers, F.col("conv").eqNullSafe(F.col("of"))).join(
        spoken, F.col("conv").eqNullSafe(F.col("conv2")) & F.col("part").eqNullSafe(F.col("part2")) & (F.col("perspective") == F.col("role")), "left")
    before = Window.partitionBy("of", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.sum(F.col("size") - F.coalesce("less", F.lit(0))).over(before)
    return every.select("of", F.col("part").alias("at_part"), "perspective", F.coalesce(starts, F.lit(0)).cast("long").alias("starts_at"))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           system_roles: tuple[str, ...] = ("system",), part_turns: int = PART_TURNS) -> DataFrame:
    """One row per conversation, perspective and part: ``n_turns``, ``starts_at``,
    the rendered ``text``, ``mask_spans`` (``start:end``, comma-joined) and ``n_target`` (characters under the mask)."""
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("unknown")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    first = rows.groupBy(F.col("conv").alias("conv1")).agg(F.min("turn").alias("first"))
    rows = rows.join(first, F.col("conv").eqNullSafe(F.col("conv1"))).withColumn("part", F.floor((F.col("turn") - F.col("first")) / part_turns).cast("long"))
    parts = rows.groupBy("conv", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    both = parts.join(_places(rows, system_roles), F.col("conv").eqNullSafe(F.col("of")) & F.col("part").eqNullSafe(F.col("at_part")))

    def head(t: Column) -> Column:
        return F.when(t["role"].isin(*system_roles), F.lit(BEGIN + "system\n")).when(t["role"] == F.col("perspective"), F.lit(BEGIN + "assistant\n")).otherwise(
            F.concat(F.lit(BEGIN + "user name="), _plain(t["role"]), F.lit("\n")))

    both = both.withColumn("turns", F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), F.concat(_plain(t["text"]), F.lit(END)).alias("body"), (t["role"] == F.col("perspective")).alias("own"))))
    size = lambda t: F.length(t["head"]) + F.length(t["body"]) + 1
    # (characters so far, spans): one pass over a part's turns
    walk = F.aggregate(
        "turns", F.struct(F.col("starts_at").alias("at"), F.lit(0).cast("long").alias("target"), F.array().cast("array<string>").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + size(t)).alias("at"), (s["target"] + F.when(t["own"], F.length(t["body"])).otherwise(0)).alias("target"),
            F.when(t["own"], F.concat(s["spans"], F.array(F.concat_ws(":", (s["at"] + F.length(t["head"])).cast("string"), (s["at"] + F.length(t["head"]) + F.length(t["body"])).cast("string")))))
            .otherwise(s["spans"]).alias("spans")))
    both = both.withColumn("walk", walk)
    return both.select(
        F.col("conv").alias(conv_col), "perspective", "part", F.size("turns").cast("long").alias("n_turns"), "starts_at",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit("\n"))), "").alias("text"),
        F.array_join("walk.spans", ",").alias("mask_spans"), F.col("walk.target").alias("n_target"))


def op3_perspectives(spark, sf_dir: str) -> DataFrame:
    return rotate(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))


OP3_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, CAST(floor((turn - min(turn) OVER (PARTITION BY conv_id)) / {PART_TURNS}.0) AS BIGINT) AS part, coalesce(role, 'unknown') AS role, coalesce("text", '') AS body
  FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
rendered AS (
  SELECT t.conv_id, perspective, part, turn, role, body,
    CASE WHEN role = 'system' THEN '{BEGIN}system' WHEN role = perspective THEN '{BEGIN}assistant'
         ELSE '{BEGIN}user name=' || replace(role, '<|', '< |') END || chr(10) AS head,
    replace(body, '<|', '< |') || '{END}' AS said, role = perspective AS own
  FROM t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, row_number() OVER w AS k, sum(length(head) + length(said) + 1) OVER w - length(said) - 1 AS begins
  FROM rendered WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY part NULLS FIRST, turn, role, body ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, part, count(*) AS n_turns, CAST(min(begins - length(head)) AS BIGINT) AS starts_at, string_agg(head || said || chr(10), '' ORDER BY k) AS "text",
  coalesce(string_agg(CAST(begins AS BIGINT) || ':' || CAST(begins + length(said) AS BIGINT), ',' ORDER BY k) FILTER (WHERE own), '') AS mask_spans,
  CAST(coalesce(sum(length(said)) FILTER (WHERE own), 0) AS BIGINT) AS n_target
FROM placed GROUP BY conv_id, perspective, part
"""
