"""Images that come into sight batch by batch."""

import os
import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from frameweir.session import new_folder
from frameweir.sinks.committed import ImageWriter, commit_images, committed_images, manifest


def images(spark, *rows):
    return spark.createDataFrame([(p, None if b is None else bytearray(b)) for p, b in rows], "path string, png binary")


def seen(spark, folder):
    return {r.path: (r.batch_id, bytes(r.png)) for r in committed_images(spark, folder).collect()}


def test_latest_batch_wins_and_a_repeated_batch_changes_nothing(spark):
    out = new_folder(spark, "images")
    assert seen(spark, out) == {}
    commit_images(images(spark, ("/o/a.png", b"1"), ("/o/b.png", b"2")), out, 0, "/o/")
    commit_images(images(spark, ("/o/a.png", b"3")), out, 1, "/o/")
    commit_images(images(spark, ("/o/a.png", b"other"), ("/o/c.png", b"4")), out, 0, "/o/")
    assert seen(spark, out) == {"/o/a.png": (1, b"3"), "/o/b.png": (0, b"2")}
    assert os.listdir(f"{out}/_pending") == []


def test_images_that_cannot_be_written_are_in_the_manifest(spark):
    out = new_folder(spark, "images")
    bad = [("/o/../a.png", b"1"), ("/elsewhere/a.png", b"1"), (None, b"1"), ("/o/none.png", None)]
    commit_images(images(spark, *bad, ("/o/äö ü%20.png", b"good")), out, prefix="/o/")
    errors = {r.path: r.error for r in manifest(spark, out).collect()}
    assert errors.pop("/o/äö ü%20.png") is None
    assert errors.pop("/o/none.png") == "the format has no such image"
    assert set(errors.values()) == {"the name leaves the folder"} and len(errors) == 3
    assert seen(spark, out) == {"/o/äö ü%20.png": (0, b"good")}


def test_a_batch_without_images(spark):
    out = new_folder(spark, "images")
    commit_images(images(spark), out)
    assert seen(spark, out) == {}
    commit_images(images(spark, ("x.png", b"")), out, 1)
    assert seen(spark, out) == {"x.png": (1, b"")}


def test_a_failed_batch_leaves_nothing_in_sight(spark):
    out = new_folder(spark, "images")
    rows = spark.range(0, 40, 1, 4)
    fails = F.when(F.col("id") == 33, F.raise_error(F.lit("spoiled")).cast("string")).otherwise("good")
    broken = rows.select(F.concat(F.lit("p"), "id").alias("path"), F.encode(fails, "UTF-8").alias("png"))
    with pytest.raises(Exception, match="spoiled"):
        commit_images(broken, out, 7)
    assert seen(spark, out) == {} and not [x for x in os.listdir(out) if x.startswith("batch_id")]
    commit_images(rows.select(F.concat(F.lit("p"), "id").alias("path"), F.lit(b"x").alias("png")), out, 7)
    assert len(seen(spark, out)) == 40


def test_attempts_that_are_not_committed_are_dropped(spark):
    out = new_folder(spark, "images")
    writer = ImageWriter({"path": out, "batchid": "2"})
    batch = pa.RecordBatch.from_pydict({"path": ["a", "b"], "png": pa.array([b"1", b"2"], pa.binary())})

    def dies():
        yield batch
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(dies())
    twice = [writer.write(iter([batch, batch.slice(1)])) for _ in range(2)]  # a speculative one
    empty = writer.write(iter([]))
    assert seen(spark, out) == {}
    writer.commit([twice[1], empty, None])
    assert os.listdir(f"{out}/batch_id=2") == [twice[1].folder] and twice[1].images == 3
    assert {r.path for r in manifest(spark, out).collect()} == {"a", "b"}


def test_a_worker_dies(spark):
    job = os.path.join(os.path.dirname(__file__), "committed_job.py")
    out = new_folder(spark, "images")
    done = subprocess.run([sys.executable, job, out], capture_output=True, text=True, timeout=200)
    assert "as expected" in done.stdout, done.stderr[-2000:]
