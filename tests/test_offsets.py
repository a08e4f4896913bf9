"""The ledger, and the source that reads a stored topic by offsets."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from frameweir.operators.objects import parse_objects
from frameweir.session import new_folder
from frameweir.sinks.topics import keyed_records
from frameweir.sources.ledger import Ledger, ledger_table
from frameweir.sources.offsets import TopicReader, stream_topic_table
from tests.helpers import frame_rows, message, records

BOUNDS = {0: (5, 20), 1: (0, 7)}


def test_reset_only_where_nothing_is_committed(tmp_path):
    ledger = Ledger(f"{tmp_path}/ledger")
    assert ledger.start("g", "t", BOUNDS, "earliest") == {0: 5, 1: 0}
    assert ledger.start("g", "t", BOUNDS, "latest") == {0: 20, 1: 7}
    ledger.append("g", "t", {0: 9})
    ledger.append("other", "t", {0: 11, 1: 3})
    ledger.append("g", "t2", {1: 2})
    assert ledger.start("g", "t", BOUNDS, "earliest") == {0: 9, 1: 0}
    assert ledger.start("g", "t", BOUNDS, "latest") == {0: 9, 1: 7}
    ledger.append("g", "t", {0: 6})  # back, on purpose
    assert ledger.offsets("g", "t") == {0: 6}
    ledger.append("g", "t", {0: 15}, "planned")
    assert ledger.offsets("g", "t") == {0: 6} and ledger.offsets("g", "t", "planned") == {0: 15}


def test_compaction_keeps_what_counts(spark, tmp_path):
    folder = f"{tmp_path}/ledger"
    ledger = Ledger(folder)
    for k in range(20):
        ledger.append("g", "t", {k % 3: k})
        ledger.append("h", "t", {0: 100 + k}, "planned")
    before = ledger._latest()
    # a compaction that fails before it removes anything leaves the same state
    ledger._append([{k: v for k, v in row.items() if k != "entry"} for row in before.values()])
    assert {k: r["offset"] for k, r in ledger._latest().items()} == {k: r["offset"] for k, r in before.items()}
    ledger.compact()
    assert len(os.listdir(folder)) == 1
    assert {k: r["offset"] for k, r in ledger._latest().items()} == {k: r["offset"] for k, r in before.items()}
    ledger.append("g", "t", {0: 50})
    rows = {(r.group, r.partition): r.offset for r in ledger_table(spark, folder).collect()}
    assert rows == {("g", 0): 50, ("g", 1): 19, ("g", 2): 17}


def test_two_readers_of_a_group_are_noticed(tmp_path, monkeypatch):
    first, second = Ledger(f"{tmp_path}/l"), Ledger(f"{tmp_path}/l")
    stale = second._numbers()
    first.append("g", "t", {0: 1})
    monkeypatch.setattr(second, "_numbers", lambda: stale)
    with pytest.raises(RuntimeError, match="another reader"):
        second.append("g", "t", {0: 2})


@pytest.fixture(scope="module")
def topic(spark):
    """Two partitions with gaps, in three files; one file mixes the partitions."""
    folder = new_folder(spark, "topic")
    rows = spark.range(200).select(
        F.lit("k").cast("binary").alias("key"),
        F.concat(F.lit("v"), "id").cast("binary").alias("value"),
        F.lit("t").alias("topic"),
        (F.col("id") % 2).cast("int").alias("partition"),
        (F.col("id") * 3).alias("offset"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    rows.where("partition = 0").coalesce(1).write.parquet(folder)
    rows.where("partition = 1 and offset < 300").coalesce(1).write.mode("append").parquet(folder)
    rows.where("offset = 303").unionAll(rows.where("partition = 1 and offset > 303")).coalesce(1).write.mode("append").parquet(folder)
    return folder


def options(topic, tmp_path, **more):
    return {"path": topic, "subscribe": "t", "group": "g", "ledger": f"{tmp_path}/ledger", **more}


def test_ranges_and_limits(topic, tmp_path):
    reader = TopicReader(options(topic, tmp_path, startingOffsets="earliest", maxOffsetsPerTrigger="200"))
    start = reader.initialOffset()
    assert start == {"0": 0, "1": 3}
    ends, found = [start], []
    while (end := reader.latestOffset()) != ends[-1]:
        slices = reader.partitions(ends[-1], end)
        rows = pa.Table.from_batches([b for s in slices for b in reader.read(s)])
        found += list(zip(rows["partition"].to_pylist(), rows["offset"].to_pylist()))
        assert all(int(ends[-1][str(p)]) <= o < int(end[str(p)]) for p, o in found[-rows.num_rows :])
        ends.append(end)
    assert all(int(b[p]) - int(a[p]) <= 100 for a, b in zip(ends, ends[1:]) for p in b)
    assert sorted(found) == sorted((k % 2, 3 * k) for k in range(200)) and len(ends) == 7
    # files out of range are not opened: one of three holds these
    assert len({s.path for s in reader.partitions({"0": 0, "1": 3}, {"0": 0, "1": 100})}) == 1


def test_latest_and_restart(topic, tmp_path):
    reader = TopicReader(options(topic, tmp_path))
    assert reader.initialOffset() == reader.latestOffset() == {"0": 595, "1": 598}
    again = TopicReader(options(topic, tmp_path / "b", startingOffsets="earliest", maxOffsetsPerTrigger="20"))
    first = again.latestOffset()
    again.commit(first)
    planned = again.latestOffset()
    after = TopicReader(options(topic, tmp_path / "b", startingOffsets="earliest", maxOffsetsPerTrigger="20"))
    assert after.initialOffset() == first
    assert after.latestOffset() == planned  # what was handed out last, then further
    assert after.latestOffset() == {p: o + 10 for p, o in planned.items()}


def test_stream_goes_on_from_its_checkpoint(spark, topic, tmp_path):
    out, checkpoint = new_folder(spark, "out"), new_folder(spark, "checkpoint")
    for batches in (2, 100):
        stream = stream_topic_table(spark, **options(topic, tmp_path, startingOffsets="earliest", maxOffsetsPerTrigger=200))

        def keep(batch, batch_id, last=batches):
            if batch_id >= last:
                raise OSError("enough")
            batch.write.mode("overwrite").parquet(f"{out}/b={batch_id}")

        query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).start()
        try:
            query.processAllAvailable()
            query.processAllAvailable()
        except Exception as failure:
            assert "enough" in str(failure)
        query.stop()
    got = spark.read.parquet(out)
    assert sorted((r.partition, r.offset) for r in got.collect()) == sorted((k % 2, 3 * k) for k in range(200))
    assert got.where("cast(value as string) = concat('v', cast(offset / 3 as int)) and timestamp = '2024-01-01'").count() == 200


def test_objects_of_any_shape(spark):
    texts = [
        message("a", extra=1, name="x"),
        message("a", rows="1"),
        message("a", cols=None),
        message("a", rows="many"),
        message("a", type=[1]),
        '{"a":1,"a":2}',
        "[1,2]",
        "17",
        "{",
        "  ",
        None,
        '{"cameraId":null}',
    ]
    got = [r for r in parse_objects(records(spark, list(zip([0] * 20, range(20), texts)))).orderBy("offset").collect()]
    assert [r.reason for r in got] == [None, None, "missing field", "other type", "other type", "malformed", "no object", "no object", "malformed", "empty", "empty", "missing field"]
    assert got[0].extra == ["extra", "name"] and got[1].rows == 1 and got[3].cameraId == "a" and got[7].extra is None


def test_records_name_their_partition(spark):
    rows = frame_rows(spark, [("foobar", 0, "t", 1), ("21", 0, "t", 2)])
    got = {r.key: r.partition for r in keyed_records(rows, 12).collect()}
    assert got == {"foobar": (-790332482 & 0x7FFFFFFF) % 12, "21": (-973932308 & 0x7FFFFFFF) % 12}
    assert keyed_records(rows).columns == ["key", "value"]
