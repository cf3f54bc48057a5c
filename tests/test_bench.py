"""bench.py prints one JSON line with the agreed fields."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_json_line(smoke_dir):
    env = dict(os.environ, BENCH_SF_DIR=smoke_dir, BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_QUERIES="q_top_n,q_sum_per_order")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"q_top_n", "q_sum_per_order"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-2
