"""Jobs survive a failed task attempt: sink output whole, counters counted once."""

import json
import os
import subprocess
import sys


def test_failed_task_attempt_is_retried_cleanly(tmp_dir):
    script = os.path.join(os.path.dirname(__file__), "retry_job.py")
    res = subprocess.run([sys.executable, script, tmp_dir], capture_output=True, text=True, timeout=600)
    line = [x for x in res.stdout.splitlines() if x.startswith("{")]
    assert line, res.stderr[-2000:]
    got = json.loads(line[-1])
    assert got.pop("failed_attempts") >= 2  # the injected failures did happen
    assert got == {"observed": 1000, "rows": 1000, "distinct": 1000, "hidden": 0, "reduce_ok": True}
