"""Run named queries over an input folder and write each result as parquet.

    spark-submit --py-files bizlens.zip -m bizlens.run --input s3://.../sf1000 \
        --output s3://.../results [--input-bytes N] [name-prefix ...]

The session comes from the cluster (master, executors and
``spark.checkpoint.dir`` are set by the submitter); ``--input-bytes`` sizes
shuffle and scan partitions with ``session.cluster_settings``. Each query's
result is written to ``<output>/<name>``; the written table is the sink of the
original scripts' CREATE TABLE AS / CREATE VIEW.
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession

from bizlens.plans import spark_queries, store_tables
from bizlens.session import cluster_settings


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="bizlens.run")
    ap.add_argument("--input", required=True, help="folder with the input parquet tables")
    ap.add_argument("--output", required=True, help="folder for one parquet result per query")
    ap.add_argument("--input-bytes", type=int, default=0, help="input volume, to size partitions")
    ap.add_argument("--store", action="store_true",
                    help="write the joined and numbered tables once, under spark.checkpoint.dir, and drop them at the end")
    ap.add_argument("names", nargs="*", help="query names or prefixes (default: all)")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName("bizlens").getOrCreate()
    if a.input_bytes:
        for k, v in cluster_settings(a.input_bytes).items():
            spark.conf.set(k, v)
    store = store_tables(spark, a.input) if a.store else None
    qs = spark_queries(store)
    names = [n for n in sorted(qs) if not a.names or any(n.startswith(p) for p in a.names)]
    try:
        for n in names:
            t0 = time.perf_counter()
            qs[n](spark, a.input).write.mode("overwrite").parquet(f"{a.output.rstrip('/')}/{n}")
            print(json.dumps({"query": n, "sec": round(time.perf_counter() - t0, 3)}), flush=True)
    finally:
        if store is not None:
            store.drop()


if __name__ == "__main__":
    main()
