"""Building and writing topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from frameweir.functions.frames import frame_json
from frameweir.functions.hashing import key_partition


def keyed_records(frames: DataFrame, partitions: int | None = None) -> DataFrame:
    """Key and value of each frame message. The key is the camera, so one
    camera's frames stay in one partition and in order. With the topic's number
    of `partitions` the record also says which, by the rule that other clients
    follow, for a sink that doesn't choose by itself."""
    records = frames.select(F.col("cameraId").alias("key"), frame_json().alias("value"))
    if partitions is None:
        return records
    return records.withColumn("partition", key_partition(F.col("key").cast("binary"), partitions))


def unkeyed_records(messages: DataFrame, value: Column) -> DataFrame:
    """Plain messages without a key."""
    return messages.select(F.lit(None).cast("string").alias("key"), value.alias("value"))


def write_topic(records: DataFrame, options: dict[str, str]) -> None:
    """Write records to the topic. Needs the Kafka connector."""
    records.write.format("kafka").options(**options).save()


def stream_to_topic(records: DataFrame, options: dict[str, str], checkpoint: str) -> StreamingQuery:
    """Keep writing a stream of records to the topic."""
    writer = records.writeStream.format("kafka").options(**options)
    return writer.option("checkpointLocation", checkpoint).start()
