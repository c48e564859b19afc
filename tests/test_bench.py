"""bench.py prints exactly one JSON line with per-query seconds."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="page_views,ad_click_filter", BENCH_REPEAT="1")
    res = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, cwd=ROOT)
    assert res.returncode == 0, res.stderr[-2000:]
    lines = [ln for ln in res.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, res.stdout
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"page_views", "ad_click_filter"}
    assert out["value"] == round(sum(out["queries"].values()), 3)
