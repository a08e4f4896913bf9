"""Starting the streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from frameweir.operators.parse import bad_messages, frames, good_frames, parse_messages
from frameweir.operators.records import first_of_batch, key_value_line
from frameweir.schema import ARRIVAL
from frameweir.session import checkpointed
from frameweir.sinks.images import export_images, write_images
from frameweir.sources.registry import camera_registry
from frameweir.sources.settings import source_options
from frameweir.sources.topics import read_topic
from frameweir.streaming.emit import emit_stream
from frameweir.streaming.save import both_streams


def to_console(table: DataFrame, checkpoint: str, mode: str = "update") -> DataStreamWriter:
    """Prints a look at each micro-batch: the console sink shows its first rows."""
    return checkpointed(table.writeStream.outputMode(mode).format("console"), checkpoint)


def print_emitted(records: DataFrame, checkpoint: str, strict: bool = True) -> DataStreamWriter:
    """The processor's look: prints the emitted row of each camera and micro-batch.
    There is no place for bad messages here, so the first one fails the stream,
    unless `strict` is taken off."""
    parsed = frames(records, strict)
    parsed.printSchema()
    return to_console(emit_stream(parsed), checkpoint)


def print_query(table: DataFrame, query: str, view: str, checkpoint: str) -> DataStreamWriter:
    """Prints what a SQL query over a stream gives, the stream being `view`."""
    table.createOrReplaceTempView(view)
    return to_console(table.sparkSession.sql(query), checkpoint, "append")


def store_lines(records: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """Writes one line per record, all of them, to text files."""
    lines = records.select(key_value_line().alias("value"))
    writer = lines.writeStream.format("text").option("path", folder)
    return writer.option("checkpointLocation", checkpoint)


def per_batch(folder: str, change: Callable[[DataFrame], DataFrame] | None = None):
    """Function for `foreachBatch`: store each batch once, tagged `batch_id`.
    A batch that is run again overwrites itself."""

    def run(batch: DataFrame, batch_id: int) -> None:
        table = change(batch) if change else batch
        table.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return run


def _first(batch: DataFrame) -> DataFrame:
    return first_of_batch(batch.withColumn("batch_id", F.lit(0))).drop("batch_id")


def sample_first(records: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """Keeps the first record of each micro-batch only."""
    writer = records.writeStream.foreachBatch(per_batch(folder, _first))
    return writer.option("checkpointLocation", checkpoint)


def sample_images(
    records: DataFrame, image_folder: str, folder: str, checkpoint: str
) -> DataStreamWriter:
    """Exports the first record of each micro-batch only, as an image file under
    its raw name. Tables under `folder`: `report` of the images written, and
    `rejects` for first records that are no frames."""

    def run(batch: DataFrame, batch_id: int) -> None:
        first = parse_messages(_first(batch))
        images = export_images(good_frames(first), image_folder, True, ARRIVAL, work=f"{folder}/lookup")
        write_images(images, image_folder, f"{folder}/report/batch_id={batch_id}")
        bad_messages(first).write.mode("overwrite").parquet(f"{folder}/rejects/batch_id={batch_id}")

    writer = records.writeStream.foreachBatch(run)
    return writer.option("checkpointLocation", checkpoint)


def store_steps(records: DataFrame, folder: str, checkpoint: str, strict: bool = True) -> DataStreamWriter:
    """Stores what the stateful operator gives: the place of the emitted frame of each
    camera and micro-batch. As in `print_emitted` a bad message fails the stream."""
    writer = emit_stream(frames(records, strict)).writeStream.outputMode("update")
    return checkpointed(writer.foreachBatch(per_batch(folder)), checkpoint)


def store_emitted(
    records: DataFrame, folder: str, checkpoint: str, payload: bool = False, strict: bool = False
) -> list[DataStreamWriter]:
    """Two streams that store the emitted row of each camera and micro-batch under
    `folder`/emitted and bad messages under `folder`/rejects; with `strict` the
    first one fails."""
    return both_streams(records, folder, checkpoint, strict, outputs=("emitted",), payload=payload)


def cameras(spark: SparkSession, settings: dict[str, str]) -> DataFrame:
    """The camera registry of a settings file."""
    row = spark.createDataFrame([(settings["camera.id"], settings["camera.url"])], "ids string, urls string")
    return camera_registry(row, "ids", "urls")


def process(
    spark: SparkSession,
    settings: dict[str, str],
    folder: str,
    checkpoint: str,
    records: DataFrame | None = None,
) -> list[DataStreamWriter]:
    """The processor as its settings file says, as two streams: reads the topic (or
    `records`), stores emitted rows and rejects under `folder`, and writes the
    images of saved frames to `processed.output.dir`, with a report."""
    records = read_topic(spark, source_options(settings)) if records is None else records
    images = settings["processed.output.dir"]
    return both_streams(records, folder, checkpoint, outputs=("emitted",), image_folder=images, image_files=True)


def run_all(spark: SparkSession, writers: list[DataStreamWriter]) -> None:
    """Start streams together and wait until one of them ends or fails; the others
    are stopped then."""
    queries = []
    try:
        queries += [writer.start() for writer in writers]
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()


def run_available(writer: DataStreamWriter | list[DataStreamWriter], timeout: int | None = None) -> StreamingQuery:
    """Run a stream, or several one after the other, over all that is there; the last
    one is returned."""
    for one in writer if isinstance(writer, list) else [writer]:
        query = one.trigger(availableNow=True).start()
        query.awaitTermination(timeout)
    return query
