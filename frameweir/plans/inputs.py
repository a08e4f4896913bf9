"""Records and frames that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameweir.functions.frames import encode_base64, frame_json

TOPIC = "frames-replayed"

# Offsets of the derived topic: the events shuffled, so that batches are late
# and times tie. Each run of PERIOD events fills PERIOD offsets.
PERIOD = 1000003
STRIDE = 7919
BATCH = 100001


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_records(spark: SparkSession, folder: str) -> DataFrame:
    """Topic records, one per event, tagged with the batch they arrive in.

    Most hold a frame message of 4 x 4 pixels in 3 channels; some hold each
    kind of bad message, and some have no key.
    """
    every = lambda n: F.col("event_id") % n == 0
    camera = F.concat(F.lit("cam-"), F.col("user_id") % 16)
    hour = F.concat(F.substring(F.col("ts").cast("string"), 1, 13), F.lit(":00:00.0"))
    size = F.when(every(109), 40).otherwise(48)
    digest = F.sha2(F.col("event_id").cast("string"), 256)
    pixels = encode_base64(F.encode(F.substring(digest, F.lit(1), size), "UTF-8"))
    data = F.when(every(107), F.concat(F.lit("***"), pixels)).otherwise(pixels)
    huge = every(131)  # a geometry whose size is beyond 64 bits
    code = F.when(huge, 2147483640).when(every(127), 18).otherwise(16)
    side = F.when(huge, 2147483647).otherwise(4)

    def message(rows):
        return frame_json(camera, hour, rows, side, code, data)

    value = (
        F.when(every(101), F.col("event_type"))
        .when(every(97), F.col("props"))
        .when(every(103) & every(2), "")
        .when(every(103), None)
        .when(every(113), message(F.lit("4")))
        .otherwise(message(side))
    )
    lap = F.floor(F.col("event_id") / PERIOD)
    return (
        table(spark, folder, "events")
        .withColumn("offset", F.col("event_id") * STRIDE % PERIOD + lap * PERIOD)
        .select(
            F.when(~every(89), camera).cast("binary").alias("key"),
            value.cast("binary").alias("value"),
            F.lit(TOPIC).alias("topic"),
            (F.col("user_id") % 16 % 4).cast("int").alias("partition"),
            "offset",
            F.col("ts").cast("timestamp").alias("timestamp"),
            F.lit(0).alias("timestampType"),
            F.floor(F.col("offset") / BATCH).cast("int").alias("batch_id"),
        )
    )


def document_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's bytes as a gray frame of one row."""
    data = F.encode(F.col("text"), "UTF-8")
    return table(spark, folder, "documents").select(
        F.concat(F.lit("doc-"), "source").alias("cameraId"),
        F.col("doc_id").alias("frame_id"),
        F.lit(1).alias("rows"),
        F.octet_length(data).alias("cols"),
        F.lit(0).alias("type"),
        data.alias("bytes"),
    )


def _pixel(place):
    """Eight-bit gray from a number in about -1..1."""
    value = F.floor((place.cast("double") + 1) * 128)
    return F.greatest(F.lit(0), F.least(F.lit(255), value)).cast("int")


def embedding_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Each embedding of 64 numbers as a gray frame of 8 x 8 pixels."""
    values = F.transform("embedding", lambda v: F.lpad(F.hex(_pixel(v)), 2, "0"))
    return table(spark, folder, "embeddings").select(
        F.concat(F.lit("cam-"), "label").alias("cameraId"),
        F.col("vec_id").alias("frame_id"),
        F.lit(8).alias("rows"),
        F.lit(8).alias("cols"),
        F.lit(0).alias("type"),
        F.unhex(F.array_join(values, "")).alias("bytes"),
    )


def camera_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Camera lists, one settings row per 50 customers, with blanks around the
    entries and empty entries at the end."""
    key = F.col("c_custkey")
    address = (
        F.when(key % 25 == 7, " ")
        .when(key % 25 == 8, "99999999999")
        .when(key % 3 == 0, (key % 10).cast("string"))
        .when(key % 3 == 1, F.concat(F.lit("rtsp://cam/"), key))
        .otherwise(F.concat(F.lit(" /video/"), key, F.lit(".mp4 ")))
    )
    entry = F.struct(key, F.concat(F.lit(" "), "c_name").alias("id"), address.alias("url"))

    def joined(name: str):
        return F.concat(F.array_join(F.transform("entries", lambda e: e[name]), ","), F.lit(",,"))

    return (
        table(spark, folder, "customer")
        .groupBy(F.floor(key / 50).alias("site"))
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .select("site", joined("id").alias("ids"), joined("url").alias("urls"))
    )
