"""Queries that keep tables in the shared folder, on executors in processes of their own."""

import os
import subprocess
import sys

QUERIES = """export_committed export_sampled export_saved final_state first_records frame_order offset_reads
sampled_frames save_flags state_after_stream stream_emit stream_export stream_first stream_lines stream_order
stream_rejects stream_save stream_state""".split()


def test_folder_without_a_scheme(tmp_path):
    job = os.path.join(os.path.dirname(__file__), "cluster_job.py")
    plain = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK", "SPARK"))}
    done = subprocess.run([sys.executable, job, str(tmp_path), *QUERIES], capture_output=True, text=True, timeout=900, env=plain)
    found = dict(line.split(" ", 1) for line in done.stdout.splitlines() if line.split(" ")[0] in QUERIES)
    assert {x: found.get(x) for x in QUERIES if not found.get(x, "none").startswith("ok")} == {}, done.stderr[-2000:]
