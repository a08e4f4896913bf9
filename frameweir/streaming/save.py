"""The per-camera step with payloads, as two streams.

The first one, over topic records, parses each micro-batch once and lands it: a
folder per batch with frames and rejects, and a folder with the frames' places,
which comes into sight by being renamed, so all at once and once only. The
second one reads the places, runs the stateful operator on them, and writes
flags, emitted rows, order and images, taking payloads from the landed folders
of its batches. The state lies in the second stream's checkpoint; nothing is
rewritten but the cameras of a batch.

Either stream may fail anywhere. A batch whose places are in sight is not landed
again; a micro-batch of the second stream overwrites its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from frameweir.operators.joins import lookup_join
from frameweir.operators.parse import bad_messages, good_frames, parse_messages, refuse_bad
from frameweir.operators.positions import POSITION, with_positions
from frameweir.operators.state import frame_order
from frameweir.schema import FRAME_ORDER, HISTORY_ORDER
from frameweir.session import checkpointed, file_system, stored
from frameweir.sinks.images import export_images, write_images
from frameweir.streaming.emit import emit_stream

_PLACES = "cameraId string, batch_id bigint, timestamp string, partition int, offset bigint"


# ---- landing ------------------------------------------------------------------------


def _numbers(spark: SparkSession, folder: str, name: str) -> list[int]:
    """The batches that have a folder of that name."""
    system, place = file_system(spark, f"{folder}/{name}")
    found = [x.getPath().getName() for x in system.listStatus(place)] if system.exists(place) else []
    return sorted(int(x.partition("=")[2]) for x in found if x.partition("=")[2].isdigit())


def _rename(spark: SparkSession, source: str, target: str) -> None:
    system, place = file_system(spark, target)
    system.mkdirs(place.getParent())
    if not system.rename(file_system(spark, source)[1], place):
        raise RuntimeError(f"{source} could not be moved to {target}")


def land_batch(folder: str, strict: bool = False) -> Callable[[DataFrame, int], None]:
    """Function for `foreachBatch` over topic records: writes `landed` and `rejects`
    under `folder`, then the places. With `strict` a bad message fails the batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id in _numbers(spark, folder, "places"):
            return  # the stream failed after this batch was in sight
        # Parsed once; the text is kept where the frame is not.
        parsed = parse_messages(batch)
        parsed = refuse_bad(parsed) if strict else parsed
        text = F.when(F.col("reason").isNotNull(), F.col("message"))
        parsed = stored(parsed.withColumn("message", text), folder=f"{folder}/landed/batch_id={batch_id}")
        bad_messages(parsed).write.mode("overwrite").parquet(f"{folder}/rejects/batch_id={batch_id}")
        places = good_frames(parsed).select("cameraId", F.lit(batch_id).cast("bigint").alias("batch_id"), *FRAME_ORDER)
        stored(places, folder=f"{folder}/side")
        _rename(spark, f"{folder}/side", f"{folder}/places/batch={batch_id}")

    return run


def landing(records: DataFrame, folder: str, checkpoint: str, strict: bool = False) -> DataStreamWriter:
    """The first stream."""
    writer = records.writeStream.foreachBatch(land_batch(folder, strict))
    return writer.option("checkpointLocation", f"{checkpoint}/landing")


def landed_frames(spark: SparkSession, folder: str, batches: list[int]) -> DataFrame:
    """The good frames of landed batches, with `batch_id` and their positions."""
    paths = [f"{folder}/landed/batch_id={n}" for n in batches]
    return good_frames(with_positions(spark.read.option("basePath", f"{folder}/landed").parquet(*paths)))


# ---- stepping -----------------------------------------------------------------------


def _at(place: str) -> Column:
    here = F.lit(True)
    for name in FRAME_ORDER:
        here = here & (F.col(name) == F.col(f"{place}{name}"))
    return here


def chained(places: DataFrame, steps: DataFrame) -> DataFrame:
    """`frame_order` of the frames of some batches, as part of a longer history: the
    first frame of each camera follows the last one that the state held before.

    `places` are range-sorted into slices of equal size, whatever the cameras;
    `steps` (what `emit_stream` gives for them) has one row per camera and batch.
    """
    held = F.when(F.col("had_state"), F.struct([F.col(f"prev_{name}").alias(name) for name in HISTORY_ORDER]))
    earliest = steps.groupBy("cameraId").agg(F.min_by(F.struct(held.alias("place")), "batch_id").alias("held"))
    rows = lookup_join(frame_order(places), earliest, ["cameraId"])
    place = F.when(F.col("saved"), F.struct([F.col(f"prev_{name}").alias(name) for name in HISTORY_ORDER])).otherwise(F.col("held.place"))
    rows = rows.withColumn("place", place)
    previous = [F.col(f"place.{name}").alias(f"prev_{name}") for name in HISTORY_ORDER]
    return rows.select("cameraId", *HISTORY_ORDER, "position", *previous, F.col("place").isNotNull().alias("saved"))


def step_batch(
    folder: str,
    outputs: tuple[str, ...] = ("frames",),
    image_folder: str | None = None,
    image_files: bool = False,
    payload: bool = True,
    keep: bool = False,
) -> Callable[[DataFrame, int], None]:
    """Function for `foreachBatch` over what `emit_stream` gives for the places.

    Writes under `folder`, per micro-batch, of `outputs`: `frames` (every good
    frame with `saved`, `is_last`, `had_state`, `prev_timestamp`, `n_frames`),
    `emitted` (the emitted row of each camera and batch, with its frame or,
    without `payload`, with its place only) and `order` (position of every
    frame, and the frame before it). With `image_folder` also the images of
    the saved frames: as a table `images`, or, with `image_files`, as files and
    a table `report`. Batches that an earlier micro-batch has handled lose
    their landed folders, unless `keep` says otherwise.
    """

    def run(steps: DataFrame, step: int) -> None:
        spark = steps.sparkSession
        steps = stored(steps, folder=f"{folder}/steps")
        batches = sorted(row.batch_id for row in steps.select("batch_id").distinct().collect())  # of this micro-batch
        if not batches:
            return
        for name in () if keep else ("landed", "places"):
            key = "batch_id" if name == "landed" else "batch"
            for old in (n for n in _numbers(spark, folder, name) if n < batches[0]):
                system, place = file_system(spark, f"{folder}/{name}/{key}={old}")
                system.delete(place, True)
        frames = landed_frames(spark, folder, batches)
        keys = ["cameraId", "batch_id"]

        def write(table: DataFrame, name: str) -> None:
            table.write.mode("overwrite").parquet(f"{folder}/{name}/step={step}")

        def flagged() -> DataFrame:
            known = steps.select(
                *keys,
                *[f"first_{name}" for name in FRAME_ORDER],
                *[F.col(name).alias(f"last_{name}") for name in FRAME_ORDER],
                "n_frames",
                "prev_timestamp",
                "had_state",
            )
            joined = lookup_join(frames, known, keys, is_stored=True)
            joined = joined.withColumn("saved", F.col("had_state") | ~_at("first_")).withColumn("is_last", _at("last_"))
            return joined.drop(*[f"{side}_{name}" for side in ("first", "last") for name in FRAME_ORDER])

        if "frames" in outputs:
            write(flagged().drop(*POSITION), "frames")
        if "emitted" in outputs:
            last = steps.select(*keys, *FRAME_ORDER, "n_frames", "had_state", "prev_timestamp", "n_saved")
            if payload:
                last = lookup_join(frames.drop("topic", *POSITION), last, [*keys, *FRAME_ORDER], "inner", folder=f"{folder}/lookup")
            write(last, "emitted")
        if "order" in outputs:
            paths = [f"{folder}/places/batch={n}" for n in batches]
            write(chained(spark.read.schema(_PLACES).parquet(*paths), steps), "order")

        if image_folder is not None:
            saved = flagged().where("saved")
            images = export_images(saved, image_folder, keep=("batch_id", "partition", "offset"), work=f"{folder}/lookup")
            if image_files:
                write_images(images, image_folder, f"{folder}/report/step={step}")
            else:
                write(images, "images")

    return run


def stepping(spark: SparkSession, folder: str, checkpoint: str, **options) -> DataStreamWriter:
    """The second stream; `options` as in `step_batch`. All places in sight make one
    micro-batch, however many batches they are: a batch is never split."""
    system, place = file_system(spark, f"{folder}/places/batch")
    system.mkdirs(place)
    # No file is ever too old to be read: this stream may be behind by any time.
    places = spark.readStream.schema(_PLACES).option("maxFileAge", "36500d").parquet(f"{folder}/places/*")
    writer = emit_stream(places).writeStream.outputMode("update").foreachBatch(step_batch(folder, **options))
    return checkpointed(writer, f"{checkpoint}/stepping")


def both_streams(records: DataFrame, folder: str, checkpoint: str, strict: bool = False, **options) -> list[DataStreamWriter]:
    """Both streams, to be started together, or one after the other on what is there."""
    return [landing(records, folder, checkpoint, strict), stepping(records.sparkSession, folder, checkpoint, **options)]
