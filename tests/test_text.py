"""Time text, file names, lists and addresses."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from frameweir.functions.hashing import key_hash, key_partition
from frameweir.functions.text import file_name, list_entries, raw_file_name, stamp_text
from frameweir.session import stored
from frameweir.sources.registry import camera_registry


@pytest.mark.parametrize(
    "time, text",
    [
        ("2021-01-02 03:04:05", "2021-01-02 03:04:05.0"),
        ("2021-01-02 03:04:05.6", "2021-01-02 03:04:05.6"),
        ("2021-01-02 03:04:05.678", "2021-01-02 03:04:05.678"),
        ("2021-01-02 03:04:05.678912", "2021-01-02 03:04:05.678"),
        ("2021-01-02 03:04:05.000912", "2021-01-02 03:04:05.0"),
        ("2021-01-02 03:04:05.0309", "2021-01-02 03:04:05.03"),
        ("2021-01-02 03:04:05.1009", "2021-01-02 03:04:05.1"),
    ],
)
def test_stamp(spark, time, text):
    for kind in ("timestamp", "timestamp_ntz"):
        row = spark.range(1).select(stamp_text(F.lit(time).cast(kind)).alias("s")).first()
        assert row.s == text


def test_stamp_of_now(spark):
    now = spark.range(1).select(stamp_text().alias("s")).first().s
    assert len(now.split(".")[0]) == 19 and 1 <= len(now.split(".")[1]) <= 3
    many = spark.range(6000000, numPartitions=2).select(
        "id", F.spark_partition_id().alias("task"), stamp_text().alias("s")
    )
    many = stored(many, "stamps")
    assert many.where(r"not s rlike '^[0-9-]{10} [0-9:]{8}\\.[0-9]{1,3}$'").count() == 0
    assert many.select("s").distinct().count() > 100
    # Inside a task the clock never steps back; a row reads it once.
    at = F.to_timestamp("s").alias("at")
    before = F.lag("at").over(Window.partitionBy("task").orderBy("id"))
    assert many.select("id", "task", at).withColumn("before", before).where("at < before").count() == 0


def test_file_names(spark):
    stamps = spark.createDataFrame([("c", "2021-01-02 \t03:04:05.0")], "c string, t string")
    row = stamps.select(
        file_name("/out/", F.col("c"), F.col("t")).alias("clean"),
        raw_file_name("/out", F.col("c"), F.col("t")).alias("raw"),
    ).first()
    assert row.clean == "/out/c-T-2021-01-02-03-04-05-0.png"
    assert row.raw == "/outc-T-2021-01-02 \t03:04:05.0.png"


@pytest.mark.parametrize(
    "text, entries",
    [
        ("a,b,,", ["a", "b"]),
        (" a ,\tb\n", ["a", "b"]),
        (",a", ["", "a"]),
        ("a,,b", ["a", "", "b"]),
        ("a, ,", ["a", ""]),
        ("", [""]),
        (",,", []),
        ("a\u00a0", ["a\u00a0"]),
    ],
)
def test_list_entries(spark, text, entries):
    assert spark.range(1).select(list_entries(F.lit(text)).alias("e")).first().e == entries


def registry(spark, ids, urls):
    lists = spark.createDataFrame([(ids, urls)], "ids string, urls string")
    return [tuple(row) for row in camera_registry(lists, "ids", "urls").collect()]


def test_registry(spark):
    assert registry(spark, "a, b,c,d,e,,", "0,/tmp/x.mp4, 2147483647 ,2147483648, ") == [
        ("a", "0", "device"),
        ("b", "/tmp/x.mp4", "url"),
        ("c", "2147483647", "device"),
        ("d", "2147483648", "invalid"),
        ("e", "", "invalid"),
    ]


def test_registry_of_different_lengths(spark):
    with pytest.raises(PySparkException, match="differ in length"):
        registry(spark, "a,b", "u")


# Fixed values, known from the public algorithm: hashes as signed numbers.
HASHES = {
    "21": -973932308,
    "abc": 479470107,
    "foobar": -790332482,
    "a-little-bit-long-string": -985981536,
    "a-little-bit-longer-string": -1486304829,
    "lkjh234lh9fiuh90y23oiuhsafujhadof229phr9h19h89h8": -58897971,
}


def test_partition_of_a_key(spark):
    rows = spark.createDataFrame([(k,) for k in [*HASHES, "", None, "ä"]], "key string").withColumn("b", F.col("key").cast("binary"))
    got = {r.key: (r.h, r.p) for r in rows.select("key", key_hash(F.col("b")).alias("h"), key_partition(F.col("b"), 12).alias("p")).collect()}
    for key, value in HASHES.items():
        assert got[key] == (value % 2**32, (value & 0x7FFFFFFF) % 12)
    assert got[None] == (None, None) and got[""][0] == 275646681 and 0 <= got["ä"][1] < 12
