"""bench.py prints one JSON line with metric / value / unit / queries / sf."""

import json
import os
import subprocess
import sys

from tests.conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_QUERIES="cohort_one_pass,hub_upsert",
               BENCH_KEYED_READ="0", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    rec = json.loads(out[0])
    assert rec["metric"] == "total_query_seconds" and rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"cohort_one_pass", "hub_upsert"}
    assert rec["runs"] == 3 and all(rec["median"][q] >= t for q, t in rec["queries"].items())
    assert abs(rec["value"] - sum(rec["queries"].values())) < 1e-6
