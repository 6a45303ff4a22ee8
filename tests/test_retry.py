"""Failed task attempts are retried without changing results (keys included)."""

import os
import subprocess
import sys


def test_merges_survive_task_retries(tmp_path):
    script = os.path.join(os.path.dirname(__file__), "helpers", "retry_run.py")
    env = dict(os.environ, RETRY_MARKS=str(tmp_path))
    out = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600, env=env)
    assert out.stdout.strip().splitlines()[-1] == "OK", (out.stdout[-2000:], out.stderr[-2000:])
    assert len(os.listdir(tmp_path)) >= 2  # failures were injected and retried
