"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="ais_clean,dark_gaps", BENCH_REPEAT="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], cwd=ROOT, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec)
    assert set(rec["queries"]) == {"ais_clean", "dark_gaps"} and rec["unit"] == "sec" and rec["sf"] == "0.001"
