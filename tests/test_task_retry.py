import json
import os
import subprocess
import sys


def test_results_survive_a_failed_task(tmp_dir):
    worker = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_worker.py")
    markers = os.path.join(tmp_dir, "markers")
    os.makedirs(markers)
    env = dict(os.environ, RETRY_MARKERS=markers)
    out = subprocess.run([sys.executable, worker, os.path.join(tmp_dir, "ckpt")], capture_output=True,
                         text=True, timeout=600, env=env)
    last = [line for line in out.stdout.splitlines() if line.startswith("{")]
    assert last, out.stderr[-2000:]
    res = json.loads(last[-1])
    assert res["failures"] >= 1          # the injected failure really happened, and was retried
    assert res["same"] is True
