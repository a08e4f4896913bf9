"""Settings files, connector options and topic shapes."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from frameweir.schema import RECORD_SCHEMA
from frameweir.sinks.topics import unkeyed_records, write_topic
from frameweir.sources.settings import (
    load_settings,
    parse_settings,
    reader_options,
    sink_options,
    source_options,
)
from frameweir.sources.topics import read_topic, read_topic_table
from frameweir.session import new_folder
from tests.helpers import records

TEXT = r"""
# a comment
! another
kafka.bootstrap.servers=broker:9092
kafka.topic = frames
kafka.acks:all
kafka.retries 7
kafka.batch.size=65536
kafka.linger.ms=20
kafka.max.request.size=3000000
kafka.compression.type=zstd
kafka.group.id=tests
kafka.auto.offset.reset=earliest
kafka.max.partition.fetch.bytes=4000000
kafka.max.poll.records=77
camera.url=C:\\videos\\a.avi,\
    0
camera.id=a\u0062,c\=d
empty=
processed.output.dir=C:\\out\\
last=1"""


def test_properties():
    found = parse_settings(TEXT)
    assert found["kafka.bootstrap.servers"] == "broker:9092"
    assert found["kafka.topic"] == "frames"
    assert found["kafka.acks"] == "all"
    assert found["kafka.retries"] == "7"
    assert found["camera.url"] == r"C:\videos\a.avi,0"
    assert found["camera.id"] == "ab,c=d"
    assert found["empty"] == ""
    assert found["processed.output.dir"] == "C:\\out\\"
    assert found["last"] == "1"
    assert len(found) == 17


def test_settings_file(tmp_path):
    path = tmp_path / "app.properties"
    path.write_text("a = b \n")
    assert load_settings(str(path)) == {"a": "b "}


def test_options():
    found = parse_settings(TEXT)
    assert source_options(found) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "frames",
        "kafka.max.partition.fetch.bytes": "4000000",
        "kafka.max.poll.records": "77",
    }
    assert reader_options(found) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "frames",
        "startingOffsets": "earliest",
        "kafka.group.id": "tests",
    }
    assert sink_options(found) == {
        "kafka.bootstrap.servers": "broker:9092",
        "topic": "frames",
        "kafka.acks": "all",
        "kafka.retries": "7",
        "kafka.batch.size": "65536",
        "kafka.linger.ms": "20",
        "kafka.max.request.size": "3000000",
        "kafka.compression.type": "zstd",
    }
    with pytest.raises(KeyError):
        source_options({"kafka.topic": "frames"})


def test_connector_is_asked_for(spark):
    """The connector is not installed here: the calls reach it and no further."""
    options = source_options(parse_settings(TEXT))
    for streaming in (True, False):
        with pytest.raises(PySparkException, match="kafka"):
            read_topic(spark, options, streaming)
    one = unkeyed_records(spark.sql("select 'hello' as text"), F.col("text"))
    with pytest.raises(PySparkException, match="kafka"):
        write_topic(one, sink_options(parse_settings(TEXT)))


def test_topic_table(spark):
    path = new_folder(spark, "topic")
    records(spark, [(0, 1, "x")]).drop("batch_id").write.parquet(path)
    for streaming in (True, False):
        table = read_topic_table(spark, path, streaming)
        assert [f.name for f in table.schema] == RECORD_SCHEMA.fieldNames()
        assert table.isStreaming == streaming


def test_unkeyed(spark):
    row = unkeyed_records(spark.sql("select 'hello' as text"), F.col("text")).first()
    assert (row.key, row.value) == (None, "hello")
