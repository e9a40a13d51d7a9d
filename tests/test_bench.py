"""bench.py keeps the driver contract: one JSON line on stdout."""

import json
import os
import subprocess
import sys
from pathlib import Path

from zonehour.plans.catalog import QUERIES

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPS="1", BENCH_PIPELINE="0")
    proc = subprocess.run(
        [sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True, text=True, timeout=900
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == set(QUERIES)
    assert abs(out["value"] - sum(out["queries"].values())) < 1e-3
