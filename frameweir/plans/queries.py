"""The registered queries. Each takes (spark, folder of the given tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameweir.functions.frames import (
    base64_bytes,
    byte_count,
    channels,
    decode_base64,
    encode_base64,
    frame_json,
)
from frameweir.functions.hashing import key_partition
from frameweir.functions.text import file_name, raw_file_name, stamp_text
from frameweir.operators import state
from frameweir.operators.images import (
    assemble_frames,
    decode_frames,
    each_once,
    frame_pixels,
    pixel_sums,
    png_contents,
    resize_frames,
    resize_tiles,
)
from frameweir.operators.joins import lookup_join
from frameweir.operators.objects import parse_objects as objects_of
from frameweir.operators.parse import frames, parse_messages, rejects, value_to_text
from frameweir.operators.positions import POSITION, with_positions
from frameweir.operators.records import first_of_batch, key_value_line
from frameweir.plans.collector import collect_frames
from frameweir.plans.inputs import (
    camera_lists,
    document_frames,
    embedding_frames,
    event_records,
    table,
)
from frameweir.schema import FRAME_FIELDS, FRAME_ORDER, HISTORY_ORDER, RECORD_SCHEMA
from frameweir.session import new_folder, stored
from frameweir.sinks.committed import commit_images, committed_images
from frameweir.sinks.images import export_images, latest_images
from frameweir.sinks.topics import keyed_records, unkeyed_records
from frameweir.sources.offsets import stream_topic_table
from frameweir.sources.registry import camera_registry
from frameweir.streaming.emit import state_places
from frameweir.streaming.replay import replay
from frameweir.streaming.run import per_batch, run_available, sample_first, store_lines, store_steps
from frameweir.streaming.save import land_batch, landed_frames, stepping

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

IMAGES = "/out/"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def event_frames(spark: SparkSession, folder: str) -> DataFrame:
    return frames(event_records(spark, folder))


# Records and messages


@query
def topic_records(spark, folder):
    return event_records(spark, folder).withColumns(
        {
            "key": F.col("key").cast("string"),
            "value": F.col("value").cast("string"),
            "timestamp": F.col("timestamp").cast("string"),
        }
    )


@query
def value_text(spark, folder):
    return value_to_text(event_records(spark, folder))


@query
def parse_frames(spark, folder):
    return event_frames(spark, folder)


@query
def reject_messages(spark, folder):
    return rejects(event_records(spark, folder))


@query
def parse_objects(spark, folder):
    """Messages of which some hold more than a frame, and some a list."""
    value, end = F.col("value").cast("string"), F.lit(',"site":{"name":"s","floor":2},"quality":0.5}')
    more = F.concat(F.substring(value, F.lit(1), F.char_length(value) - 1), end)
    value = F.when(F.col("offset") % 7 == 0, F.concat(F.lit("["), value, F.lit("]"))).when((F.col("offset") % 5 == 0) & value.endswith('"}'), more).otherwise(value)
    objects = objects_of(event_records(spark, folder).withColumn("value", value.cast("binary")))
    return objects.select("partition", "offset", *FRAME_FIELDS, F.array_join("extra", ",").alias("extra"), "reason")


@query
def reject_documents(spark, folder):
    """Whole texts as payloads, some spoiled: the reason for each document."""
    text = encode_base64(F.col("bytes"))
    kind = F.col("frame_id") % 8
    data = (
        F.when(kind == 1, F.rtrim(text, F.lit("=")))
        .when(kind == 2, F.concat(F.substring(text, 1, 4), F.lit("\n"), F.substring(text, 5, 2**30)))
        .when(kind == 3, F.decode("bytes", "UTF-8"))
        .when(kind == 4, F.concat(text, F.lit("=")))
        .when(kind == 5, F.concat(text, F.lit("AAAA")))
        .otherwise(text)
    )
    value = frame_json(F.col("cameraId"), F.lit("2024-01-01 00:00:00.0"), F.col("rows"), F.col("cols"), F.col("type"), data)
    records = document_frames(spark, folder).select(
        value.alias("value"), F.lit(0).alias("partition"), F.col("frame_id").alias("offset")
    )
    return parse_messages(records).select(F.col("offset").alias("doc_id"), "reason")


@query
def build_json(spark, folder):
    """Messages built again from the decoded frames."""
    decoded = event_frames(spark, folder).withColumn("data", encode_base64(decode_base64(F.col("data"))))
    return keyed_records(decoded)


@query
def unkeyed_messages(spark, folder):
    return unkeyed_records(table(spark, folder, "conversations"), F.col("text"))


@query
def keyed_partitions(spark, folder):
    """The partition, of twelve, of records by their key: cameras, and keys of many
    lengths; none where there is no key."""
    events, part = table(spark, folder, "events"), table(spark, folder, "part")
    camera = F.when(F.col("event_id") % 89 != 0, F.concat(F.lit("cam-"), F.col("user_id") % 16))
    user = F.concat("user_id", F.repeat(F.lit("."), (F.col("event_id") % 5).cast("int")))
    keys = events.select(F.lit("camera").alias("kind"), F.col("event_id").alias("id"), camera.alias("key"))
    keys = keys.unionAll(events.select(F.lit("user"), "event_id", user)).unionAll(part.select(F.lit("part"), "p_partkey", "p_name"))
    return keys.withColumn("partition", key_partition(F.col("key").cast("binary"), 12))


@query
def key_value_lines(spark, folder):
    records = event_records(spark, folder)
    return records.select("partition", "offset", key_value_line().alias("line"))


@query
def first_records(spark, folder):
    first = first_of_batch(event_records(spark, folder))
    return first.select("batch_id", "partition", "offset", F.col("value").cast("string").alias("message"))


@query
def sampled_frames(spark, folder):
    """The first record of each batch as a frame, with its raw image path."""
    sampled = frames(first_of_batch(event_records(spark, folder)))
    path = raw_file_name(IMAGES, F.col("cameraId"), F.col("timestamp"))
    return sampled.select("batch_id", path.alias("path"), "rows", "cols", "type", "data")


# Column functions


@query
def base64_roundtrip(spark, folder):
    data = encode_base64(F.col("bytes"))
    return document_frames(spark, folder).select(
        F.col("frame_id").alias("doc_id"),
        data.alias("data"),
        base64_bytes(data).alias("n_bytes"),
        (decode_base64(data) == F.col("bytes")).alias("same"),
    )


@query
def stamps(spark, folder):
    events = table(spark, folder, "events").select(
        F.lit("event").alias("kind"), F.col("event_id").alias("id"), stamp_text(F.col("ts")).alias("stamp")
    )
    orders = table(spark, folder, "orders").select(
        F.lit("order"), F.col("o_orderkey"), stamp_text(F.col("o_orderdate"))
    )
    return events.unionAll(orders)


def _named(spark, folder, name):
    camera = F.concat(F.lit("cam-"), F.col("user_id") % 16)
    path = name(IMAGES, camera, stamp_text(F.col("ts")))
    return table(spark, folder, "events").select("event_id", path.alias("path"))


@query
def file_names(spark, folder):
    return _named(spark, folder, file_name)


@query
def raw_file_names(spark, folder):
    return _named(spark, folder, raw_file_name)


@query
def geometry(spark, folder):
    decoded = decode_frames(event_frames(spark, folder)).withColumn("frame_id", F.col("offset"))
    sets = {
        "event": decoded,
        "document": document_frames(spark, folder),
        "embedding": embedding_frames(spark, folder),
    }
    parts = [
        frame_set.select(
            F.lit(name).alias("frame_set"),
            "frame_id",
            "rows",
            "cols",
            "type",
            channels(F.col("type")).alias("channels"),
            byte_count(F.col("rows"), F.col("cols"), F.col("type")).alias("n_expected"),
            F.octet_length("bytes").alias("n_bytes"),
        )
        for name, frame_set in sets.items()
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query
def cameras(spark, folder):
    return camera_registry(camera_lists(spark, folder), "ids", "urls")


# Pixels


@query
def pixels(spark, folder):
    return frame_pixels(decode_frames(event_frames(spark, folder)), ["partition", "offset"])


def _hex_pixels(resized: DataFrame, keys: list[str]) -> DataFrame:
    return resized.select(*keys, "rows", "cols", "type", F.hex("bytes").alias("pixels"))


@query
def resize_events(spark, folder):
    decoded = decode_frames(event_frames(spark, folder)).select("offset", "rows", "cols", "type", "bytes")
    return _hex_pixels(resize_frames(decoded, 8, 8), ["offset"])


@query
def resize_embeddings(spark, folder):
    """Sides that are no multiples of each other."""
    return _hex_pixels(resize_frames(embedding_frames(spark, folder), 12, 20), ["frame_id"])


@query
def resize_vga(spark, folder):
    resized = resize_frames(embedding_frames(spark, folder))
    return pixel_sums(resized, ["frame_id", "rows", "cols", "type"])


@query
def resize_tiled(spark, folder):
    """As `resize_vga`, in tiles whose sides divide nothing."""
    tiles = resize_tiles(embedding_frames(spark, folder), ["frame_id"], side=210)
    whole = assemble_frames(tiles, ["frame_id"], in_turn=True)
    return each_once(pixel_sums(whole, ["frame_id", "rows", "cols", "type"]), ["frame_id", "type"])


@query
def collected(spark, folder):
    at = F.timestamp_micros(F.lit(1704067200000000) + F.col("frame_id") * 37250)
    return collect_frames(embedding_frames(spark, folder), at, 16, 16)


# The per-camera step


@query
def emit_per_batch(spark, folder):
    records = event_records(spark, folder)
    return state.emit_per_batch(frames(records), records)


@query
def frames_per_batch(spark, folder):
    return state.frames_per_batch(event_frames(spark, folder))


@query
def previous_timestamp(spark, folder):
    return state.previous_timestamp(event_frames(spark, folder))


@query
def save_flags(spark, folder):
    # Two passes over the frames: parse once, and keep the narrow columns.
    narrow = event_frames(spark, folder).select("cameraId", *HISTORY_ORDER)
    return state.save_flags(stored(narrow, "frames"))


@query
def frame_order(spark, folder):
    return state.frame_order(event_frames(spark, folder))


@query
def final_state(spark, folder):
    records = event_records(spark, folder)
    return state.final_state(frames(records), records)


# Images


PLACE = ("batch_id", "partition", "offset")


@query
def export_saved(spark, folder):
    # Several passes, of which one reads payloads.
    landed = with_positions(stored(event_frames(spark, folder), "frames"))
    saved = state.save_flags(landed).where("saved")
    return png_contents(export_images(saved, IMAGES, keep=PLACE))


@query
def export_sampled(spark, folder):
    sampled = frames(first_of_batch(event_records(spark, folder)))
    return png_contents(export_images(sampled, IMAGES, raw_names=True, order=list(PLACE), keep=PLACE))


@query
def export_committed(spark, folder):
    """The saved frames as files, half of the batches at a time; the first half is
    written twice, as after a restart. Read back through the manifests."""
    landed = with_positions(stored(event_frames(spark, folder), "frames"))
    images = export_images(state.save_flags(landed).where("saved"), IMAGES, keep=PLACE)
    images = stored(images, "images")
    out = new_folder(spark, "committed")
    for batch_id in (0, 1, 0):
        commit_images(images.where(F.col("batch_id") % 2 == batch_id), out, batch_id, IMAGES)
    shown = png_contents(committed_images(spark, out).drop("batch_id"))
    return shown.join(images.select("path", *PLACE), "path")


# Streams


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def _stepped(spark: SparkSession, folder: str, name: str, **options) -> tuple[str, str]:
    """The folder of the per-camera step over the replayed records, and the checkpoint
    of its state. Both streams are stopped half-way and go on from there."""
    out, checkpoint = new_folder(spark, name), new_folder(spark, "checkpoint")

    def start(records, landing_checkpoint):
        return records.writeStream.foreachBatch(land_batch(out)).option("checkpointLocation", landing_checkpoint)

    replay(event_records(spark, folder), start, after=lambda: run_available(stepping(spark, out, checkpoint, **options)))
    return out, f"{checkpoint}/stepping"


def _steps_of(spark: SparkSession, folder: str, output: str, **options) -> DataFrame:
    out, _ = _stepped(spark, folder, output, **options)
    return _stored(spark, f"{out}/{output}").drop("step")


@query
def stream_emit(spark, folder):
    return _steps_of(spark, folder, "emitted", outputs=("emitted",))


@query
def stream_rejects(spark, folder):
    out = new_folder(spark, "landed")
    replay(event_records(spark, folder), lambda records, checkpoint: records.writeStream.foreachBatch(land_batch(out)).option("checkpointLocation", checkpoint))
    return _stored(spark, f"{out}/rejects")


@query
def stream_order(spark, folder):
    """Position of every frame and the frame before it, across batches and restarts."""
    return _steps_of(spark, folder, "order", outputs=("order",))


@query
def state_after_stream(spark, folder):
    """The state of each camera out of the checkpoint, with its frame out of the batch
    it came in."""
    out, checkpoint = _stepped(spark, folder, "state", outputs=(), keep=True)
    places = stored(state_places(spark, checkpoint).drop("n_frames"), "state")
    batches = sorted(row.batch_id for row in places.select("batch_id").distinct().collect())
    return lookup_join(landed_frames(spark, out, batches), places, ["cameraId", *HISTORY_ORDER], "left_semi", is_stored=True).drop("topic", *POSITION)


@query
def stream_state(spark, folder):
    """The stateful operator; `task_ok`: its rows come from the state's partitions."""
    out = new_folder(spark, "steps")
    replay(event_records(spark, folder), lambda records, checkpoint: store_steps(records, out, checkpoint, strict=False))
    last = int(spark.conf.get("spark.sql.shuffle.partitions")) - 1
    steps = _stored(spark, out).withColumn("task_ok", F.col("task_partition").between(0, last))
    return steps.select("cameraId", "batch_id", *FRAME_ORDER, "n_frames", "had_state", "prev_timestamp", "n_saved", "n_before", "n_partitions", "task_ok")


@query
def stream_save(spark, folder):
    return _steps_of(spark, folder, "frames", outputs=("frames",)).drop("topic")


@query
def stream_export(spark, folder):
    """Images of the saved frames, of each path the latest over all batches."""
    images = _steps_of(spark, folder, "images", outputs=(), image_folder=IMAGES)
    return png_contents(latest_images(images))


@query
def stream_first(spark, folder):
    out = new_folder(spark, "first")
    replay(event_records(spark, folder), lambda records, checkpoint: sample_first(records, out, checkpoint))
    first = _stored(spark, out)
    return first.select("batch_id", "partition", "offset", F.col("value").cast("string").alias("message"))


@query
def stream_lines(spark, folder):
    out = new_folder(spark, "lines")
    replay(event_records(spark, folder), lambda records, checkpoint: store_lines(records, out, checkpoint))
    return spark.read.text(out).select(F.col("value").alias("line"))


# Offsets a micro-batch takes of all partitions, and the micro-batch that fails.
TAKEN, FAILS = 400_000, 3


@query
def offset_reads(spark, folder):
    """Two reads of a topic by one group, a few offsets at a time. The first one fails
    in its fourth micro-batch; the second one, without the checkpoint of the
    first, goes on where the ledger says."""
    topic, ledger, out = (new_folder(spark, name) for name in ("topic", "ledger", "reads"))
    records = event_records(spark, folder).select(*RECORD_SCHEMA.fieldNames())
    records.repartitionByRange(8, "partition", "offset").sortWithinPartitions("partition", "offset").write.parquet(topic)
    for read, fails in ((1, FAILS), (2, None)):

        def handle(batch, batch_id, read=read, fails=fails):
            if batch_id == fails:
                raise OSError("lost")
            facts = [F.count(F.lit(1)).alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")]
            table = batch.groupBy("partition").agg(*facts).withColumn("batch", F.lit(batch_id))
            table.withColumn("read", F.lit(read)).write.mode("overwrite").parquet(f"{out}/read={read}-batch={batch_id}")

        records = stream_topic_table(spark, path=topic, subscribe="frames", group="g", ledger=ledger, startingOffsets="earliest", maxOffsetsPerTrigger=TAKEN)
        query = records.writeStream.foreachBatch(handle).option("checkpointLocation", new_folder(spark, "checkpoint")).start()
        try:
            query.processAllAvailable()
        except StreamingQueryException:
            if fails is None:
                raise
        finally:
            query.stop()
    return spark.read.parquet(f"{out}/*")


@query
def stream_view(spark, folder):
    """A SQL query over the parsed stream."""
    out = new_folder(spark, "view")

    def start(records, checkpoint):
        frames(records).createOrReplaceTempView("frame_events")
        writer = spark.sql("select * from frame_events").writeStream.foreachBatch(per_batch(out))
        return writer.option("checkpointLocation", checkpoint)

    replay(event_records(spark, folder), start)
    return _stored(spark, out)
