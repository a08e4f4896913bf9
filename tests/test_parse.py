"""Parsing, rejects, base64 and geometry."""

import base64
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from frameweir.functions.frames import (
    base64_bytes,
    byte_count,
    channels,
    decode_base64,
    encode_base64,
    is_base64,
)
from frameweir.operators.parse import frames, parse_messages, rejects
from frameweir.operators.records import first_of_batch, key_value_line
from frameweir.schema import FRAME_FIELDS
from frameweir.sinks.topics import keyed_records
from tests.helpers import message, records

GOOD = message()

CASES = {
    "good": (GOOD, None),
    "extra field": (message(extra="1"), None),
    "escaped padding": (message(rows=1, cols=2, data="eHk\\u003d").replace("\\\\u", "\\u"), None),
    "number as camera": (message(cameraId=5), None),
    "empty frame": (message(rows=0, cols=0, data=""), None),
    "three channels": (message(rows=1, cols=1, code=16, pixels=b"bgr"), None),
    "not JSON": ("Hello", "malformed"),
    "truncated": (GOOD[:-5], "malformed"),
    "array": (f"[{GOOD}]", "malformed"),
    "text for a number": (message(rows="7"), "malformed"),
    "fraction for a number": (message(rows=7.5), "malformed"),
    "empty": ("", "empty"),
    "blank": ("  ", "empty"),
    "null": (None, "empty"),
    "one field": ('{"cameraId":"c"}', "missing field"),
    "no data": (message(data=None), "missing field"),
    "wrong case": (GOOD.replace("cameraId", "cameraid"), "missing field"),
    "16-bit": (message(code=2), "bad type"),
    "stars": (message(data="***"), "bad base64"),
    "single character": (message(data="A"), "bad base64"),
    "line break": (message(data="eH\nk="), "bad base64"),
    "too much padding": (message(data="eHk=="), "bad base64"),
    "no padding": (message(data="eHk"), None),
    "too long": (message(cols=1), "bad length"),
    "too short": (message(cols=3), "bad length"),
    "negative": (message(rows=-1, cols=-2), "bad length"),
}


def test_reasons(spark):
    rows = [(0, i, text) for i, (text, _) in enumerate(CASES.values())]
    table = records(spark, rows)
    found = {row.offset: row.reason for row in parse_messages(table).collect()}
    assert [found[i] for i in range(len(CASES))] == [reason for _, reason in CASES.values()]
    good = [i for i, (_, reason) in enumerate(CASES.values()) if reason is None]
    assert sorted(row.offset for row in frames(table).collect()) == good
    bad = {row.offset: row.message for row in rejects(table).collect()}
    assert bad == {i: text for i, (text, reason) in enumerate(CASES.values()) if reason}


def test_escaped_padding_reads_as_padding(spark):
    text, _ = CASES["escaped padding"]
    assert "\\u003d" in text
    assert frames(records(spark, [(0, 0, text)])).first().data == "eHk="


def test_strict_fails(spark):
    with pytest.raises(PySparkException, match="bad frame message: malformed"):
        frames(records(spark, [(0, 0, GOOD), (0, 1, "Hello")]), strict=True).collect()
    assert frames(records(spark, [(0, 0, GOOD)]), strict=True).count() == 1


def test_frame_types(spark):
    table = frames(records(spark, [(0, 0, GOOD)])).select(*FRAME_FIELDS)
    assert [kind for _, kind in table.dtypes] == ["string", "string", "int", "int", "int", "string"]


def test_json_is_parsed_once(spark):
    plan = frames(records(spark, [(0, 0, GOOD)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_message_order(spark):
    built = keyed_records(frames(records(spark, [(0, 0, GOOD)]))).first()
    assert built.key == "a"
    assert built.value == (
        '{"cameraId":"a","timestamp":"2024-01-01 00:00:00.0","rows":1,"cols":2,"type":0,"data":"eHk="}'
    )


def strict_decode(text):
    """What a strict basic decoder gives; padding may be left out."""
    body = text.rstrip("=")
    if any(c not in ALPHABET for c in body):
        return None
    pads = len(text) - len(body)
    if len(body) % 4 == 1 or (pads and (pads > 2 or (len(body) + pads) % 4)):
        return None
    return base64.b64decode(body + "=" * (-len(body) % 4))


ALPHABET = string.ascii_letters + string.digits + "+/"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text("AQz+/=\n *-", max_size=9), min_size=20, max_size=60))
def test_strict_base64(spark, texts):
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    got = table.select("t", is_base64(F.col("t")).alias("ok"), decode_base64(F.col("t")).alias("b"), base64_bytes(F.col("t")).alias("n"))
    for row in got.collect():
        wanted = strict_decode(row.t)
        assert row.ok == (wanted is not None), row
        assert (bytes(row.b) if row.b is not None else None) == wanted, row
        if wanted is not None:
            assert row.n == len(wanted), row


@pytest.mark.parametrize("chunked", ["true", "false"])
def test_base64_has_one_line(spark, chunked):
    before = spark.conf.get("spark.sql.chunkBase64String.enabled")
    spark.conf.set("spark.sql.chunkBase64String.enabled", chunked)
    try:
        data = bytes(range(256)) * 3
        table = spark.createDataFrame([(bytearray(data),)], "b binary")
        assert table.select(encode_base64(F.col("b")).alias("t")).first().t == base64.b64encode(data).decode()
    finally:
        spark.conf.set("spark.sql.chunkBase64String.enabled", before)


def test_geometry(spark):
    table = spark.createDataFrame([(480, 640, 16), (2, 3, 0), (2, 3, 24), (50000, 50000, 16)], "r int, c int, t int")
    got = table.select(channels(F.col("t")).alias("n"), byte_count(F.col("r"), F.col("c"), F.col("t")).alias("b"))
    assert [tuple(row) for row in got.collect()] == [(3, 921600), (1, 6), (4, 24), (3, 7500000000)]


def test_lines(spark):
    table = spark.createDataFrame([("k", "v"), (None, "v"), (None, None)], "key string, value string")
    lines = [row.line for row in table.select(key_value_line().alias("line")).collect()]
    assert lines == ["Key: k;Value: v", "Key: null;Value: v", "Key: null;Value: null"]


def test_first_of_batch(spark):
    table = records(spark, [(0, 5, "b"), (0, 3, "a"), (1, 9, None)])
    got = first_of_batch(table).selectExpr("batch_id", "offset", "cast(value as string) v").collect()
    assert sorted(map(tuple, got)) == [(0, 3, "a"), (1, 9, None)]
