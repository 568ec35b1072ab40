"""Compare a registered Spark query with its SQL oracle on DuckDB.

Usage: python -m tests.parity [--sf DIR] [name-prefix ...]
Comparison: same column names, same row count, same multiset of rows after
normalising values (floats to 9 significant digits, decimals as numbers).
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time

import duckdb

from bizlens.sources.driver import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        if f == int(f) and abs(f) < 1e15:
            return int(f)
        return float(f"{f:.9g}")
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def normalise(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i].lower() for i in order], sorted(out, key=_key)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    sc, sr = normalise(s_cols, s_rows)
    dc, dr = normalise(d_cols, d_rows)
    problems = []
    if sc != dc:
        problems.append(f"columns spark={sc} oracle={dc}")
    if len(sr) != len(dr):
        problems.append(f"rows spark={len(sr)} oracle={len(dr)}")
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(sr), t1 - t0, t2 - t1


def main(argv=None):
    from bizlens.plans import load_all, oracle_queries, spark_queries
    from bizlens.session import local_session

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--plain-tz", default=None,
                    help="use a plain session (no bizlens settings) in this time zone")
    ap.add_argument("--conf", action="append", default=[], help="extra k=v for the plain session")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    load_all()
    qs, oq = spark_queries(), oracle_queries()
    if a.plain_tz:
        from pyspark.sql import SparkSession
        b = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", a.plain_tz))
        for kv in a.conf:
            k, v = kv.split("=", 1)
            b = b.config(k, v)
        spark = b.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session(8, 8)
    con = duck(a.sf)
    bad = 0
    for name in sorted(qs):
        if a.names and not any(name.startswith(p) for p in a.names):
            continue
        if name not in oq:
            n = qs[name](spark, a.sf).count()
            print(f"NO-ORACLE {name}: rows={n}")
            continue
        try:
            problems, n, ts, td = compare(spark, con, name, qs[name], oq[name], a.sf)
        except Exception as e:  # report and continue
            problems, n, ts, td = [f"error {type(e).__name__}: {str(e)[:400]}"], -1, 0, 0
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{status} {name}: rows={n} spark={ts:.2f}s duck={td:.2f}s {'; '.join(problems)}")
        sys.stdout.flush()
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
