"""Filter of rows before a join."""

import pytest
from bizlens.llm import common
from bizlens.llm.common import perhaps_in
from pyspark.sql import functions as F


@pytest.mark.parametrize("most", [common.MOST_BITS, 256])
def test_no_hash_is_lost_and_few_others_pass(spark, monkeypatch, most):
    monkeypatch.setattr(common, "MOST_BITS", most)
    df = spark.range(8000).select("id", F.xxhash64("id").alias("h"))
    there = df.where("id % 8 = 0")
    passed = {r["id"] for r in df.where(perhaps_in(there.select("h"))(F.col("h"))).collect()}
    assert passed >= set(range(0, 8000, 8))
    assert most == 256 or len(passed) < 1100
    assert df.where(perhaps_in(there.where("id < 0").select("h"))(F.col("h"))).count() == 0
