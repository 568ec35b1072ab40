"""Connected components of an edge table by alternating large and small stars.

Every round is a few grouped minimums and joins on edge rows; no node's
neighbours are gathered anywhere, and rounds are stored in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bizlens.llm.common import stored

EXECUTORS_LEAST, EDGES_PER_FILE = 6, 500_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node that it reaches) for every
    node with an edge. Rows with a null end, self edges and repeats count for
    nothing; an empty table gives an empty one."""
    e = (edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e, before = stored(e, "edges"), None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        # edges never grow in number, so few files hold few of them
        e = stored(small.coalesce(max(EXECUTORS_LEAST, -(-now[0] // EDGES_PER_FILE))), "edges")
