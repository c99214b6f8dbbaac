"""bench.py prints one JSON line the driver can record."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="4",
               BENCH_REPEATS="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"),
                          "triangle_count", "stream_report"],
                         env=env, capture_output=True, text=True, timeout=600, cwd=ROOT)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"triangle_count", "stream_report"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 0.01
