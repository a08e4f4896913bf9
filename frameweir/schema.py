"""The two record shapes: frame message and topic record."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, order and types of a frame message.
FRAME_SCHEMA = T.StructType(
    [
        T.StructField("cameraId", T.StringType(), False),
        T.StructField("timestamp", T.StringType(), False),
        T.StructField("rows", T.IntegerType(), False),
        T.StructField("cols", T.IntegerType(), False),
        T.StructField("type", T.IntegerType(), False),
        T.StructField("data", T.StringType(), False),
    ]
)
FRAME_FIELDS = FRAME_SCHEMA.fieldNames()

# The columns Spark's Kafka source gives.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Arrival order of one camera: its key always maps to one partition, and
# offsets rise inside a partition.
ARRIVAL = ["partition", "offset"]

# Order in which the frames of one camera and batch are handled.
FRAME_ORDER = ["timestamp", *ARRIVAL]

# Order over the whole history of a camera.
HISTORY_ORDER = ["batch_id", *FRAME_ORDER]
