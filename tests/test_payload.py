"""Payloads of real size: two gigabytes of frames through one micro-batch."""

import json
import os
import subprocess
import sys

from tests import payload_job

COUNT, CORES = 1600, 4


def test_frames_of_full_size(tmp_path):
    job = [sys.executable, payload_job.__file__, str(tmp_path), str(COUNT), str(CORES)]
    plain = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK", "SPARK"))}
    done = subprocess.run(job, capture_output=True, text=True, timeout=900, env=plain)
    assert done.returncode == 0, done.stderr[-3000:]
    found = json.loads(done.stdout.splitlines()[-1])
    assert found == {"emitted": 8, "bytes": 1228800, "frames": COUNT, "images": COUNT - 8}
