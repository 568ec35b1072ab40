"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(small_dir):
    env = dict(os.environ, BENCH_SF_DIR=small_dir, BENCH_CPUS="2",
               BENCH_QUERIES="spend_per_customer,visit_summary_intended")
    out = subprocess.run([sys.executable, "bench.py"], cwd=ROOT, env=env, capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and d["value"] > 0
    assert set(d["queries"]) == {"spend_per_customer", "visit_summary_intended"}
