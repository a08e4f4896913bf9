"""The per-camera step, as batch queries over frames tagged with a batch.

Per camera and batch the frames are ordered by time text, then by arrival. The
last one is emitted and becomes the state; every frame but a camera's very
first is saved. The state is the last frame of the latest batch, even when an
earlier batch held a later time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frameweir.operators.joins import lookup_join
from frameweir.operators.parse import frames as parsed_frames
from frameweir.schema import ARRIVAL, FRAME_FIELDS, FRAME_ORDER, HISTORY_ORDER
from frameweir.session import stored

_GROUP = ["cameraId", "batch_id"]


def last_per_batch(frames: DataFrame) -> DataFrame:
    """The place of the last frame of each camera and batch, and the number of
    frames. Each task reduces its rows before the shuffle, so a hot camera
    sends one narrow row per task."""
    last = F.max(F.struct(*FRAME_ORDER)).alias("last")
    return frames.groupBy(*_GROUP).agg(last, F.count(F.lit(1)).alias("n_frames"))


def _state_before() -> tuple[Column, Column]:
    """Over one row per camera and batch: whether the camera had a state before
    the batch, and its time text."""
    history = Window.partitionBy("cameraId").orderBy("batch_id")
    had_state = F.lag("batch_id").over(history).isNotNull()
    return had_state.alias("had_state"), F.lag("timestamp").over(history).alias("prev_timestamp")


def _with_payload(frames: DataFrame, records: DataFrame | None, places: DataFrame, keys: list[str]) -> DataFrame:
    """`places` (one row per `keys`, few) with the payload of their frames.

    With the topic `records` the frames came from, the records of the places
    are picked before their messages are parsed; else the frames are read once
    more. Either way nothing but the result is written or moved.
    """
    payload = [name for name in FRAME_FIELDS if name not in ("cameraId", "timestamp")]
    places = stored(places, "places")
    if records is not None:
        frames = parsed_frames(lookup_join(records, places.select("batch_id", *ARRIVAL), ["batch_id", *ARRIVAL], "left_semi", is_stored=True))
    return lookup_join(frames.select(*keys, *payload), places, keys, "inner", is_stored=True)


def emit_per_batch(frames: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """The emitted row of each camera and batch, payload included.

    The emitted rows are found on narrow columns, of which the window over a
    camera's history sees one row per batch; `records` as in `final_state`.
    """
    last = last_per_batch(frames).select(*_GROUP, "last.*", "n_frames")
    last = last.select("*", *_state_before())
    n_saved = F.col("n_frames") - F.when(F.col("had_state"), 0).otherwise(1)
    return _with_payload(frames, records, last.withColumn("n_saved", n_saved), [*_GROUP, *FRAME_ORDER])


def frames_per_batch(frames: DataFrame) -> DataFrame:
    """Number of frames per camera and batch."""
    return frames.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("n_frames"))


def previous_timestamp(frames: DataFrame) -> DataFrame:
    """Time text the state held before each batch of a camera."""
    # Arrival only breaks ties, which hold the same time text.
    last = frames.groupBy(*_GROUP).agg(F.max("timestamp").alias("timestamp"))
    return last.select(*_GROUP, *_state_before())


def final_state(frames: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """The state of each camera after its latest batch, payload included.

    Give the topic `records` if the frames are parsed from them: then only the
    messages of the result are parsed a second time.
    """
    last = frames.groupBy("cameraId").agg(F.max(F.struct(*HISTORY_ORDER)).alias("last")).select("cameraId", "last.*")
    return _with_payload(frames, records, last, ["cameraId", *HISTORY_ORDER])


def first_frames(frames: DataFrame) -> DataFrame:
    """The place of each camera's very first frame, in `first`."""
    return frames.groupBy("cameraId").agg(F.min(F.struct(*HISTORY_ORDER)).alias("first"))


def is_saved() -> Column:
    """Save test for a row joined to `first_frames`."""
    same = F.lit(True)
    for name in HISTORY_ORDER:
        same = same & (F.col(name) == F.col(f"first.{name}"))
    return ~same


def save_flags(frames: DataFrame) -> DataFrame:
    """All frames with `saved`: false for the first frame of a camera."""
    joined = lookup_join(frames, first_frames(frames), ["cameraId"])
    return joined.withColumn("saved", is_saved()).drop("first")


def frame_order(frames: DataFrame) -> DataFrame:
    """Position of each frame in its camera and batch, and the frame before it.

    A camera's history may be too long for one task. The rows are range-sorted
    into slices of about equal size, whatever the keys; positions and previous
    frames are found inside a slice, and the few rows at slice borders take
    theirs from a table with one row per slice, camera and batch.
    """
    spark = frames.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["cameraId", *HISTORY_ORDER]
    # Fixed in the shared folder, so that the slice numbers stay the same for
    # both uses below.
    sliced = stored(
        frames.select(*keys)
        .repartitionByRange(slices, *keys)
        .withColumn("slice", F.spark_partition_id()),
        "slices",
    )
    part = ["cameraId", "batch_id", "slice"]
    inside = Window.partitionBy(*part).orderBy(*FRAME_ORDER)
    ranked = (
        sliced.withColumn("_rank", F.row_number().over(inside))
        .withColumn("_before", F.lag(F.struct(*HISTORY_ORDER)).over(inside))
    )
    batch = Window.partitionBy(*_GROUP).orderBy("slice")
    history = Window.partitionBy("cameraId").orderBy("batch_id", "slice")
    borders = (
        sliced.groupBy(*part)
        .agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct(*HISTORY_ORDER)).alias("_end"))
        .select(
            *part,
            (F.sum("_n").over(batch) - F.col("_n")).alias("_skipped"),
            F.lag("_end").over(history).alias("_carried"),
        )
    )
    before = F.when(F.col("_rank") == 1, F.col("_carried")).otherwise(F.col("_before"))
    return (
        ranked.join(borders, part)
        .withColumn("_previous", before)
        .select(
            *keys,
            (F.col("_rank") + F.col("_skipped")).alias("position"),
            *[F.col(f"_previous.{name}").alias(f"prev_{name}") for name in HISTORY_ORDER],
            F.col("_previous").isNotNull().alias("saved"),
        )
    )
