import json
import os
import subprocess
import sys

from conftest import SF_SMALL


def test_bench_prints_one_json_line(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py"), "preprocess", "key_violations"],
                         cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and set(rec["queries"]) == {"preprocess", "key_violations"}
    assert rec["value"] > 0 and rec["sf"] == 0.001
