"""Partial states merged to any period, exact and estimated distinct counts, and
incremental refresh of aggregates by input file."""

import os
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from bizlens.operators.partials import IncrementalAggregate, count_ids, finish, id_bitmaps, merge, states

VALUES = {"total": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "ids": ("hll", "id")}


def data(seed, n=400):
    rng = random.Random(seed)
    return [(rng.choice([1, 2, 3, None]), rng.randint(0, 9), rng.choice([None, rng.randint(-50, 50)]), rng.randint(0, 60)) for _ in range(n)]


SCHEMA = "k int, day int, v int, id long"


def full(df, keys):
    return df.groupBy(*keys).agg(F.sum("v").alias("total"), F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.count_distinct("id").alias("ids"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_states_merge_to_coarser_keys(spark):
    df = spark.createDataFrame(data(1), SCHEMA)
    daily = states(df, ["k", "day"], VALUES)
    for keys in (["k", "day"], ["k"], ["day"], []):
        assert rows(finish(merge(daily, keys, VALUES), VALUES)) == rows(full(df, keys))  # sketches of few ids are exact


def test_sketches_are_within_their_error(spark):
    df = spark.range(200_000).select((F.col("id") % 7).alias("day"), (F.col("id") * 7919 % 60_000).alias("id"))
    daily = states(df, ["day"], {"ids": ("hll", "id")})
    got = finish(merge(daily, [], {"ids": ("hll", "id")}), {"ids": ("hll", "id")}).first().ids
    assert abs(got - 60_000) < 3 * 0.017 * 60_000


def test_id_bitmaps_are_exact(spark):
    rng = random.Random(3)
    data = [(rng.randint(0, 5), rng.choice([None, rng.randint(1, 200), rng.randint(1, 10**6)])) for _ in range(2000)]
    df = spark.createDataFrame(data, "m int, id long")
    sets = id_bitmaps(df, ["m"], "id")
    assert {r.m: r.n for r in count_ids(sets, ["m"], "n").collect()} == {m: len({i for x, i in data if x == m and i}) for m in range(6)}
    assert count_ids(sets, [], "n").first().n == len({i for _, i in data if i})


def write(spark, folder, name, seed, n=300):
    spark.createDataFrame(data(seed, n), SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1]])
def test_loads_in_any_order_equal_one_load(spark, order):
    folder, store = tempfile.mkdtemp(prefix="bizlens-in-"), tempfile.mkdtemp(prefix="bizlens-agg-")
    agg = IncrementalAggregate(spark, store, {"k": F.col("k"), "week": F.floor(F.col("day") / 7)}, VALUES)
    with pytest.raises(ValueError):
        agg.read(folder)
    here = f"{folder}/*"
    for i in order:
        write(spark, folder, f"part{i}", i)
        assert agg.refresh(here) == 1 and agg.refresh(here) == 0  # only what is new is read
    every = spark.read.parquet(here).withColumn("week", F.floor(F.col("day") / 7))
    assert rows(agg.read(here)) == rows(full(every, ["k", "week"]))
    assert rows(agg.read(here, ["week"])) == rows(full(every, ["week"]))
    # a file that has changed takes the place of its earlier state, one that is gone counts no more
    time.sleep(1.1)
    write(spark, folder, "part1", 77, 120)
    assert agg.refresh(here) == 1
    assert rows(agg.read(here)) == rows(full(spark.read.parquet(here).withColumn("week", F.floor(F.col("day") / 7)), ["k", "week"]))
    for name in os.listdir(f"{folder}/part2"):
        if name.endswith(".parquet") or name.endswith(".crc"):
            os.remove(f"{folder}/part2/{name}")
    left = [f"{folder}/part0", f"{folder}/part1"]
    here = f"{folder}/part[01]"
    assert agg.refresh(here) == 0
    assert rows(agg.read(here, ["k"])) == rows(full(spark.read.parquet(*left), ["k"]))
