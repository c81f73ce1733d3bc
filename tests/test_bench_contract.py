import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", PYSPARK_PYTHON=sys.executable)
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "q07_traffic_stats"],
                         capture_output=True, text=True, env=env, timeout=600, cwd=ROOT)
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-1000:]
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec)
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"q07_traffic_stats"} and rec["value"] > 0
