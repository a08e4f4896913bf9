"""From topic records to checked frames, with the rejects kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frameweir.functions.frames import base64_bytes, byte_count, depth, is_base64
from frameweir.schema import FRAME_FIELDS, FRAME_SCHEMA

_CORRUPT = "_corrupt_record"
_PARSE_SCHEMA = T.StructType([*FRAME_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])

# Columns of a topic record that a frame keeps, where there are such.
_CARRIED = ["topic", "partition", "offset", "batch_id", "_file", "_row"]


def value_to_text(records: DataFrame) -> DataFrame:
    """Record value as text, in column `message`."""
    return records.select(*_carried(records), F.col("value").cast("string").alias("message"))


def _carried(records: DataFrame) -> list[str]:
    return [name for name in _CARRIED if name in records.columns]


def _reason() -> Column:
    """Why a parsed message is no frame, or null when it is one."""
    missing = F.lit(False)
    for name in FRAME_FIELDS:
        missing = missing | F.col(name).isNull()
    return (
        F.when(F.col("json").isNull(), "empty")  # what the JSON parser gives for no text
        .when(F.col(_CORRUPT).isNotNull(), "malformed")
        .when(missing, "missing field")
        .when(depth(F.col("type")) != 0, "bad type")
        .when(~is_base64(F.col("data")), "bad base64")
        .when((F.col("rows") < 0) | (F.col("cols") < 0), "bad length")
        .when(
            # A size that overflows is null, and no payload has it.
            ~base64_bytes(F.col("data")).eqNullSafe(byte_count(F.col("rows"), F.col("cols"), F.col("type"))),
            "bad length",
        )
    )


def parse_messages(records: DataFrame) -> DataFrame:
    """Every record with its frame fields, its message and a `reason`, which is
    null for a good frame.

    The text goes through the JSON parser once: exploding the one-element array
    keeps later filters on the parsed fields from being pushed below the parse,
    which would run it again for each of them.
    """
    texts = value_to_text(records)
    carried = _carried(records)
    parsed = F.from_json("message", _PARSE_SCHEMA, {"columnNameOfCorruptRecord": _CORRUPT})
    return (
        texts.select(*carried, "message", F.explode(F.array(parsed)).alias("json"))
        .select(*carried, "message", "json", "json.*")
        .withColumn("reason", _reason())
        .drop("json", _CORRUPT)
    )


def good_frames(parsed: DataFrame) -> DataFrame:
    """The good frames of `parse_messages`, columns bound by name and type."""
    typed = [F.col(field.name).cast(field.dataType).alias(field.name) for field in FRAME_SCHEMA]
    return parsed.where(F.col("reason").isNull()).select(*_carried(parsed), *typed)


def bad_messages(parsed: DataFrame) -> DataFrame:
    """The other messages of `parse_messages`, each with its reason."""
    rows = parsed.where(F.col("reason").isNotNull())
    return rows.select(*_carried(parsed), "message", "reason")


def refuse_bad(parsed: DataFrame) -> DataFrame:
    """`parse_messages` that fails the job on the first bad message."""
    text = F.concat(F.lit("bad frame message: "), F.col("reason"))
    return parsed.withColumn("reason", F.when(F.col("reason").isNotNull(), F.raise_error(text)))


def frames(records: DataFrame, strict: bool = False) -> DataFrame:
    """The good frames of topic records.

    Bad messages are left out (see `rejects`); with `strict` the first one
    fails the job instead.
    """
    parsed = parse_messages(records)
    return good_frames(refuse_bad(parsed) if strict else parsed)


def rejects(records: DataFrame) -> DataFrame:
    """The messages of topic records that are no frames, each with a reason."""
    return bad_messages(parse_messages(records))
