"""The collector: from captured frames to keyed topic records, as one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameweir.functions.frames import encode_base64
from frameweir.functions.text import stamp_text
from frameweir.operators.images import resize_frames
from frameweir.sinks.topics import keyed_records


def collect_frames(
    captured: DataFrame, at: Column | None = None, height: int = 480, width: int = 640
) -> DataFrame:
    """Key and value of the message of each captured frame (`cameraId`, `rows`,
    `cols`, `type`, `bytes`), resized and stamped with the time `at`."""
    stamped = captured.withColumn("timestamp", stamp_text(at))
    needed = stamped.select("cameraId", "timestamp", "rows", "cols", "type", "bytes")
    resized = resize_frames(needed, height, width)
    return keyed_records(resized.withColumn("data", encode_base64(F.col("bytes"))))
