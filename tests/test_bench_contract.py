"""bench.py prints exactly one JSON line with the driver's keys."""

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_MEM="1g",
               BENCH_QUERIES="scan_window,country_risk_daily")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, cwd=str(ROOT))
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= d.keys()
    assert d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"scan_window", "country_risk_daily"} and d["value"] > 0
