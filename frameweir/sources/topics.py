"""Reading a topic, from the broker or from a table of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from frameweir.schema import RECORD_SCHEMA


def read_topic(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Records of a topic. Needs the Kafka connector on the class path.

    Bound a micro-batch with `maxOffsetsPerTrigger`, and set `minPartitions`
    when a topic has fewer partitions than the cluster has cores.
    """
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def read_topic_table(
    spark: SparkSession, path: str, streaming: bool = True, files_per_trigger: int | None = None
) -> DataFrame:
    """Records stored as Parquet files in the shape the Kafka source gives."""
    if not streaming:
        return spark.read.schema(RECORD_SCHEMA).parquet(path)
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
