import json
import os
import subprocess
import sys

from conftest import ROOT, SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMALL, BENCH_CPUS="2",
               BENCH_QUERIES="label_keywords,uri_parts")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"label_keywords", "uri_parts"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3)
