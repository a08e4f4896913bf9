"""Physical plans: what is read, what is shuffled, what is broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from frameweir.functions.text import file_name
from frameweir.operators import state
from frameweir.operators.images import resize_frames
from frameweir.operators.parse import frames
from frameweir.operators.positions import rows_by_position, with_positions
from frameweir.operators.records import first_of_batch
from frameweir.plans.inputs import embedding_frames, event_records
from frameweir.session import new_folder, stored, work_dir
from frameweir.sinks.images import last_per_path
from frameweir.sources.topics import read_topic_table
from frameweir.streaming.emit import emit_stream


@pytest.fixture(scope="module")
def landed(spark, folder):
    return stored(frames(event_records(spark, folder)), "frames")


def plan(table):
    return table._jdf.queryExecution().executedPlan().toString()


def read_columns(table):
    """The columns of each scan."""
    return [set(re.findall(r"(\w+)#", scan)) for scan in re.findall(r"FileScan parquet \[([^\]]*)\]", plan(table))]


def test_counts_read_two_columns(landed):
    assert read_columns(state.frames_per_batch(landed)) == [{"cameraId", "batch_id"}]


def test_rows_are_reduced_before_the_shuffle(landed):
    for table in (state.frames_per_batch(landed), state.last_per_batch(landed), state.first_frames(landed)):
        steps = plan(table)
        assert steps.count("Exchange hashpartitioning") == 1
        assert steps.index("Exchange hashpartitioning") < steps.index("partial_")


def test_flags_move_no_frames(landed):
    """The firsts are broadcast, so payloads stay in their tasks."""
    table = state.save_flags(landed)
    assert "Exchange hashpartitioning" not in plan(table)
    assert "BroadcastHashJoin" in plan(table)
    narrow = table.select("cameraId", "saved")
    assert all("data" not in columns for columns in read_columns(narrow))


def test_firsts_read_no_payload(landed):
    (columns,) = read_columns(state.first_frames(landed))
    assert columns == {"cameraId", "batch_id", "timestamp", "partition", "offset"}


def test_path_check_moves_no_payload(landed):
    named = landed.withColumn("path", file_name("/out/", F.col("cameraId"), F.col("timestamp")))
    steps = plan(last_per_path(named, ["batch_id", "timestamp", "partition", "offset"]))
    assert "Exchange hashpartitioning" not in steps and "BroadcastHashJoin" in steps


@pytest.mark.parametrize("limit", [0, 10**9])
def test_path_check_moves_no_payload_at_any_size(landed, limit):
    """Losers beyond the broadcast limit: each group of files is read with its own."""
    frames = with_positions(stored(landed.repartition(3), "frames")).withColumn("path", file_name("/out/", F.col("cameraId"), F.col("timestamp")))
    order = ["batch_id", "timestamp", "partition", "offset"]
    table = last_per_path(frames, order, limit=limit)
    steps = plan(table)
    assert "Exchange hashpartitioning" not in steps and "Sort" not in steps and "BroadcastHashJoin" in steps
    assert ("Union" in steps) == (limit == 0)
    plain = last_per_path(landed.withColumn("path", file_name("/out/", F.col("cameraId"), F.col("timestamp"))), order)
    got = sorted(tuple(r) for r in table.select("path", *order).collect())
    assert got == sorted(tuple(r) for r in plain.select("path", *order).collect()) and len(got) < landed.count()


def test_rows_by_position(spark):
    """Both ways, with many blocks in a file and files without any position."""
    folder = new_folder(spark, "rows")
    spark.range(0, 200_000, 1, 2).write.parquet(folder)
    spark.range(300_000, 300_010).write.mode("append").parquet(folder)
    table = with_positions(spark.read.parquet(folder))
    chosen = table.where("id % 7 = 3 and id < 200000")
    for limit in (0, 10**9):
        inside = rows_by_position(table, chosen, True, limit).select("id")
        outside = rows_by_position(table, chosen, False, limit).select("id")
        assert {r.id for r in inside.collect()} == set(range(3, 200_000, 7))
        assert outside.count() == 200_010 - len(range(3, 200_000, 7)) and outside.where("id % 7 = 3 and id < 200000").count() == 0
    assert rows_by_position(table, table.limit(0), False).count() == 200_010


@pytest.mark.parametrize("kind", ["emitted", "final", "first"])
def test_winners_move_no_payload(spark, folder, landed, kind):
    """No sort and no shuffle below the result carries a payload."""
    records = stored(event_records(spark, folder), "records")
    table, payload = {
        "emitted": lambda: (state.emit_per_batch(landed), "data"),
        "final": lambda: (state.final_state(landed), "data"),
        "first": lambda: (first_of_batch(records), "value"),
    }[kind]()
    steps = plan(table)
    assert "BroadcastHashJoin" in steps and "SortAggregate" not in steps
    assert "Sort [" not in steps and "Exchange hashpartitioning" not in steps
    assert sum(payload in columns for columns in read_columns(table)) == 1


@pytest.mark.parametrize("find", [state.emit_per_batch, state.final_state])
def test_winners_are_picked_before_the_parse(spark, folder, find):
    """Only the records of the result are parsed with their payload."""
    records = stored(event_records(spark, folder), "records")
    steps = plan(find(frames(records), records))
    assert steps.count("from_json") and "Exchange hashpartitioning" not in steps
    # read upwards: the records are joined to the places, then parsed
    assert steps.index("Generate explode") < steps.index("LeftSemi")


def test_slices_are_used_as_they_are(landed):
    """Windows and border table work on slices, never on whole cameras."""
    steps = plan(state.frame_order(landed))
    keys = re.findall(r"Window \[row_number\(\).*?\], \[([^\]]*)\]", steps)
    assert keys and all("slice" in key for key in keys)


def test_resize_does_not_shuffle(spark, folder):
    wide = stored(embedding_frames(spark, folder), "embeddings")
    assert "Exchange" not in plan(resize_frames(wide))


def test_filter_reaches_the_scan(landed):
    steps = plan(landed.where("batch_id = 3").select("cameraId"))
    assert "PushedFilters: [IsNotNull(batch_id), EqualTo(batch_id,3)]" in steps


def test_stream_reduces_tasks_before_the_state(spark, folder):
    path = new_folder(spark, "topic")
    event_records(spark, folder).drop("batch_id").write.parquet(path)
    emitted = emit_stream(frames(read_topic_table(spark, path)))
    steps = emitted._jdf.queryExecution().logical().toString()
    assert steps.index("TransformWithStateInPySpark") < steps.index("MapInPandas")
    assert "data#" not in steps[: steps.index("MapInPandas")]


def test_folder_where_none_is_named(spark):
    class Unset:
        sparkContext = spark.sparkContext
        conf = {}

    assert work_dir(Unset) == work_dir(Unset)
    Unset.sparkContext = type("Cluster", (), {"master": "yarn", "applicationId": "a"})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(Unset)
    for bare, message in (("/tmp/own", "each machine's own"), ("file:///mnt/shared", None)):
        Unset.conf = {"spark.checkpoint.dir": bare}
        Unset._jvm, Unset._jsc = spark._jvm, spark._jsc
        if message:
            with pytest.raises(RuntimeError, match=message):
                work_dir(Unset)
        else:
            assert work_dir(Unset) == bare
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert not named or new_folder(spark, "x").startswith(named.rstrip("/"))


def test_bare_folder_of_a_cluster(spark, tmp_path, monkeypatch):
    """A path without a scheme is taken where all tasks see it, and tried only once."""

    class Cluster:
        sparkContext = type("Context", (), {"master": "spark://m:7077", "applicationId": "b", "defaultParallelism": 3})
        conf = {"spark.checkpoint.dir": f"{tmp_path}/shared/"}
        _jvm, _jsc, read = spark._jvm, spark._jsc, spark.read
        range = staticmethod(spark.range)

    assert work_dir(Cluster) == f"{tmp_path}/shared"
    monkeypatch.setattr(Cluster, "range", None)
    assert new_folder(Cluster, "x").startswith(f"{tmp_path}/shared/frameweir/x-")
    # Of another application one task's file does not come back.
    Cluster.sparkContext.applicationId = "c"
    monkeypatch.setattr(Cluster, "range", staticmethod(lambda a, b, step, tasks: spark.range(a, b - 1, step, tasks)))
    with pytest.raises(RuntimeError, match="each machine's own"):
        work_dir(Cluster)
