"""Run by test_committed: a worker dies in the middle of its first attempt. Argument: a new folder."""

import os
import sys

import pyarrow as pa
from pyspark import TaskContext

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from frameweir.session import build_session  # noqa: E402
from frameweir.sinks.committed import commit_images, committed_images  # noqa: E402


def some(batches):
    context = TaskContext.get()
    for batch in batches:
        ids = batch.column("id").to_pylist()
        for i, id in enumerate(ids):
            if i == 20 and context.partitionId() == 1 and context.attemptNumber() == 0:
                os._exit(1)
            png = pa.array([b"image %d" % id], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([f"/out/{id}.png"]), png], names=["path", "png"])


out = sys.argv[1]
spark = build_session("committed", "local[2,3]", spark__ui__enabled="false")
spark.sparkContext.setLogLevel("OFF")
commit_images(spark.range(0, 90, 1, 3).mapInArrow(some, "path string, png binary"), out, 4, "/out/")
rows = {(r.path, bytes(r.png)) for r in committed_images(spark, out).collect()}
assert rows == {(f"/out/{i}.png", b"image %d" % i) for i in range(90)}
assert len([x for x in os.listdir(f"{out}/batch_id=4") if not x.startswith(".")]) == 3  # nothing of the attempt that died
assert sorted(os.listdir(f"{out}/_pending")) == []
print("as expected")
