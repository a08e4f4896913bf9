"""A stream of frames of 640 x 480 pixels in 3 channels, in a process of its own.

Arguments: folder, number of frames, cores. Runs the payload steps on one
micro-batch with one gigabyte of heap per core, and prints what it counted.
"""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from frameweir.functions.frames import encode_base64, frame_json  # noqa: E402
from frameweir.session import build_session  # noqa: E402
from frameweir.sources.topics import read_topic_table  # noqa: E402
from frameweir.streaming.run import run_available, store_emitted  # noqa: E402
from frameweir.streaming.save import both_streams  # noqa: E402


def main(folder: str, count: int, cores: int) -> None:
    spark = build_session(
        "payload",
        f"local[{cores}]",
        spark__ui__enabled="false",
        spark__driver__memory=f"{cores}g",
        spark__sql__shuffle__partitions=str(cores),
        spark__checkpoint__dir=f"{folder}/work",
    )
    spark.sparkContext.setLogLevel("ERROR")
    size = 640 * 480 * 3
    # Each frame repeats a text of its own, so that the files stay small.
    own = F.rpad(F.concat("id", F.lit(".")), 64, "frame pixels ")
    pixels = encode_base64(F.encode(F.repeat(own, F.lit(size // 64)), "UTF-8"))
    camera = F.concat(F.lit("c"), F.col("id") % 8)
    stamp = F.concat(F.lit("2024-01-01 00:00:00."), F.lpad("id", 6, "0"))
    value = frame_json(camera, stamp, F.lit(480), F.lit(640), F.lit(16), pixels)
    rows = spark.range(0, count, 1, 2 * cores).select(
        camera.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    rows.write.parquet(f"{folder}/topic")
    stream = read_topic_table(spark, f"{folder}/topic")
    run_available(store_emitted(stream, f"{folder}/emitted", f"{folder}/c1", payload=True))
    run_available(both_streams(stream, f"{folder}/saved", f"{folder}/c2", image_folder=f"{folder}/images/"))
    emitted = spark.read.parquet(f"{folder}/emitted/emitted")
    images = spark.read.parquet(f"{folder}/saved/images")
    found = {
        "emitted": emitted.count(),
        "bytes": emitted.agg(F.min(F.octet_length("data"))).first()[0],
        "frames": spark.read.parquet(f"{folder}/saved/frames").count(),
        "images": images.where("png is not null").count(),
    }
    print(json.dumps(found))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]), int(sys.argv[3]))
