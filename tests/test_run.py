"""The command-line runner and the cluster settings helper."""

import os
import tempfile

from bizlens import run
from bizlens.session import cluster_settings


def test_runner_writes_one_parquet_per_query(spark, small_dir):
    out = tempfile.mkdtemp(prefix="bizlens-run-")
    run.main(["--input", small_dir, "--output", out, "spend_per_customer", "unique_nodes"])
    assert sorted(os.listdir(out)) == ["spend_per_customer", "unique_nodes"]
    df = spark.read.parquet(f"{out}/spend_per_customer")
    assert df.columns == ["customer_id", "total_amount_spent"] and df.count() > 0


def test_cluster_settings_scale_with_input():
    small = cluster_settings(10 * 2**30, executor_cores=4, executors=10)
    big = cluster_settings(100 * 2**40, executor_cores=4, executors=1000)
    assert int(small["spark.sql.shuffle.partitions"]) == 80          # at least two waves of tasks
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 * 2**20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
