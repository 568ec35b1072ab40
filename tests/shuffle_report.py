"""Input and shuffle volumes of the headline queries, from Spark's event log.

    python -m tests.shuffle_report [sf_dir]

Runs each headline query once (noop sink) with the event log written to a new
scratch folder, then sums the task metrics of its jobs: rows read from files,
shuffle bytes written, and records shuffled. The stored domain tables are built
first, so the numbers are those of the queries alone.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile


def _lines(path: str):
    """Lines of one event log file (plain or zstd-compressed)."""
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(argv=None) -> None:
    from pyspark.sql import SparkSession

    from bench import HEADLINE
    from bizlens.plans import spark_queries, store_tables

    sf = (argv or sys.argv[1:] or ["/root/testdata/sf0.1"])[0]
    logdir = tempfile.mkdtemp(prefix="bizlens-eventlog-")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
             .config("spark.sql.shuffle.partitions", "16").config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    store = store_tables(spark, sf)
    qs = spark_queries(store)
    for name in HEADLINE:
        spark.sparkContext.setJobGroup(name, name)
        qs[name](spark, sf).write.format("noop").mode("overwrite").save()
    store.drop()
    spark.stop()

    stage_group, totals = {}, {}
    for path in sorted(glob.glob(f"{logdir}/**/*", recursive=True)):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        for line in _lines(path):
            ev = json.loads(line)
            if True:
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    g = stage_group.get(ev.get("Stage ID"))
                    if g not in HEADLINE:
                        continue
                    m = ev.get("Task Metrics") or {}
                    t = totals.setdefault(g, [0, 0, 0])
                    t[0] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                    sw = m.get("Shuffle Write Metrics") or {}
                    t[1] += sw.get("Shuffle Bytes Written", 0)
                    t[2] += sw.get("Shuffle Records Written", 0)
    print("| query | input rows read | shuffle written (MB) | shuffle records |")
    print("|---|---|---|---|")
    for name in HEADLINE:
        i, b, r = totals.get(name, [0, 0, 0])
        print(f"| {name} | {i:,} | {b / 2**20:.2f} | {r:,} |")


if __name__ == "__main__":
    main()
