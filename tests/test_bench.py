"""bench.py contract: exactly one JSON line on stdout with the expected keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g")
    res = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "combine_trades", "event_study"],
                         env=env, capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    lines = [ln for ln in res.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"combine_trades", "event_study"}
    assert d["value"] == round(sum(d["queries"].values()), 3)
