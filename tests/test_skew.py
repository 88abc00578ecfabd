"""A key holding a third of all rows is spread over tasks (checked in Spark's event log)."""
import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def stages(*args):
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "tasks.py"), *args],
                         capture_output=True, text=True, timeout=600, cwd=ROOT)
    return [json.loads(l) for l in out.stdout.splitlines() if l.startswith("{")]


def test_hot_key_is_split():
    sf = "/root/testdata/sf0.01"
    ours = stages("hot_key_change_history", sf)
    naive = stages("x", sf, "--naive-lag")
    hot = 10000 // 3
    assert max(s["max_task_shuffle_records"] for s in naive) >= hot           # one task holds the hot key
    assert max(s["max_task_shuffle_records"] for s in ours) < hot // 2        # spread over tasks
