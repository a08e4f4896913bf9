"""The per-camera step as a stateful operator of a stream, on narrow rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from frameweir.schema import ARRIVAL, FRAME_ORDER

# The store that keeps the state of many cameras on the executors' disks, with
# values that later versions of the operator may add fields to.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.encodingFormat": "avro",
}

_GROUP = ["cameraId", "batch_id"]
_PLACE = "timestamp string, partition int, offset bigint"

# Names of the two state variables, as the state data source knows them.
LAST, SEEN = "last", "seen"
_LAST = f"batch_id bigint, {_PLACE}, n_frames bigint"
_SEEN = "offset bigint"

_REDUCED = (
    f"cameraId string, batch_id bigint, {_PLACE}, first_timestamp string, first_partition int, first_offset bigint,"
    " n_frames bigint"
)
_STEP = (
    f"{_REDUCED}, had_state boolean, prev_batch_id bigint, prev_timestamp string, prev_partition int, prev_offset bigint,"
    " n_before bigint, n_saved bigint, n_partitions int, task_partition int"
)


def use_engine_state(spark: SparkSession) -> None:
    """Settings of the state store; a stream takes those of its session at its start."""
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)


def _reduced(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per camera and batch: its last and its first frame, and how many. Rows
    that were reduced before carry their own first frame and number."""
    first = [f"first_{name}" for name in FRAME_ORDER]
    by_first = rows.sort_values([*_GROUP, *first]).groupby(_GROUP, sort=True)
    by_last = rows.sort_values([*_GROUP, *FRAME_ORDER]).groupby(_GROUP, sort=True)
    kept = by_last[FRAME_ORDER].last().join(by_first[first].first()).join(by_last["n_frames"].sum())
    return kept.reset_index()[[field.split()[0] for field in _REDUCED.split(", ")]]


def _reduced_all(parts: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
    kept = None
    for part in parts:
        if len(part):
            kept = _reduced(part if kept is None else pd.concat([kept, part]))
    return kept


class CameraSteps(StatefulProcessor):
    """Per camera: `last`, the place of the last frame of the latest batch and the
    number of frames so far; `seen`, for each partition its frames came from
    the highest offset. A camera's key always leads to one partition, so more
    than one tells of a producer that leaves the key out."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState(LAST, _LAST)
        self.seen = handle.getMapState(SEEN, "partition int", _SEEN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batches = _reduced_all(rows)
        if batches is None:
            return
        before = self.last.get() if self.last.exists() else None
        partitions = {k[0]: v[0] for k, v in self.seen.iterator()}
        steps = []
        for row in batches.itertuples(index=False):
            highest = max(row.offset, row.first_offset)
            for partition in {row.partition, row.first_partition}:
                if highest > partitions.get(partition, -1):
                    partitions[partition] = highest
            had_state, earlier = before is not None, (before[4] or 0) if before else 0  # null in states of before there was a count
            previous = before[:4] if before else (None,) * 4
            steps.append((*row, had_state, *previous, earlier, row.n_frames - (not had_state), len(partitions), TaskContext.get().partitionId()))
            before = (row.batch_id, row.timestamp, row.partition, row.offset, earlier + row.n_frames)
        self.last.update(before)
        for partition, offset in partitions.items():
            self.seen.updateValue((partition,), (offset,))
        columns = {}
        for k, (name, kind) in enumerate(field.split() for field in _STEP.split(", ")):
            columns[name] = pd.array([s[k] for s in steps], {"bigint": "Int64", "int": "Int32", "boolean": "boolean"}.get(kind, "object"))
        yield pd.DataFrame(columns)

    def close(self) -> None:
        pass


def emit_stream(frames: DataFrame) -> DataFrame:
    """The step of each camera and batch, for a stream of frames: where its first and
    last frame stand, and what the state was before.

    Where the frames name their `batch_id`, a camera's batches are handled in
    that order, also several in one micro-batch; else the micro-batch is the
    batch, and numbers are null. Each input task first reduces its frames to
    one row per camera and batch, so a hot camera sends one row per task and
    batch to its state. Rows and state hold places, no payload; `save` looks
    that up. No timeout and no watermark: late frames count, and state is kept.
    """
    use_engine_state(frames.sparkSession)
    numbered = "batch_id" in frames.columns
    batch = F.col("batch_id").cast("bigint") if numbered else F.lit(0).cast("bigint")
    first = [F.col(name).alias(f"first_{name}") for name in FRAME_ORDER]
    rows = frames.select("cameraId", batch.alias("batch_id"), *FRAME_ORDER, *first, F.lit(1).cast("bigint").alias("n_frames"))

    def reduce_task(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = _reduced_all(parts)
        if kept is not None:
            yield kept

    reduced = rows.mapInPandas(reduce_task, _REDUCED).groupBy("cameraId")
    steps = reduced.transformWithStateInPandas(CameraSteps(), _STEP, "Update", "None")
    return steps if numbered else steps.drop("batch_id", "prev_batch_id")


def state_places(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state of each camera as its checkpoint holds it: cameraId, the place of the
    last frame, and the number of frames so far. Reads no frames."""
    use_engine_state(spark)
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", LAST).load()
    return state.select("key.cameraId", "value.*")


def state_partitions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """For each camera the partitions its frames came from, and the highest offset
    its batches ended or began at in each."""
    use_engine_state(spark)
    seen = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", SEEN).load()
    return seen.select("key.cameraId", "user_map_key.partition", "user_map_value.offset")
