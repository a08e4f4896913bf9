"""Column functions for frame payloads and geometry."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from frameweir.schema import FRAME_FIELDS


def channels(code: Column) -> Column:
    """Channel count packed in a matrix type code."""
    return F.shiftright(code, 3) + 1


def depth(code: Column) -> Column:
    """Depth code packed in a matrix type code; 0 is unsigned 8-bit."""
    return code.bitwiseAND(F.lit(7))


def byte_count(rows: Column, cols: Column, code: Column) -> Column:
    """Payload size of an 8-bit frame; null where a size is beyond 64 bits."""
    return F.try_multiply(F.try_multiply(rows.cast("bigint"), cols), channels(code).cast("bigint"))


def encode_base64(data: Column) -> Column:
    """Base64 on one line, padded."""
    text = F.base64(data)
    spark = SparkSession.getActiveSession()
    if spark and spark.conf.get("spark.sql.chunkBase64String.enabled") == "false":
        return text
    return F.replace(text, F.lit("\r\n"), F.lit(""))


def _pads(text: Column) -> Column:
    return F.when(text.endswith("=="), 2).when(text.endswith("="), 1).otherwise(0)


def is_base64(text: Column) -> Column:
    """Whether a strict basic decoder takes the text: alphabet characters only,
    no line breaks, padding either right or left out.

    Spark's decoder passes over blanks and line breaks, so the bytes it gives
    are fewer than a text of that length holds. Decoding is several times
    faster than matching a pattern over a payload.
    """
    size = F.octet_length(text)
    pads = _pads(text)
    found = F.octet_length(F.try_to_binary(text, F.lit("base64")))
    return (
        ((size - pads) % 4 != 1)
        & ((pads == 0) | (size % 4 == 0))
        & F.coalesce(found == base64_bytes(text), F.lit(False))
    )


def base64_bytes(text: Column) -> Column:
    """Number of bytes a valid base64 text holds, without decoding it."""
    return F.shiftright((F.octet_length(text) - _pads(text)).cast("bigint") * 3, 2)


def decode_base64(text: Column) -> Column:
    """The bytes, or null for text a strict decoder would not take."""
    return F.when(is_base64(text), F.try_to_binary(text, F.lit("base64")))


def frame_json(*fields: Column) -> Column:
    """Frame message text, fields in their fixed order."""
    named = fields or tuple(F.col(name) for name in FRAME_FIELDS)
    return F.to_json(F.struct(*[field.alias(name) for field, name in zip(named, FRAME_FIELDS)]))


def byte_at(data: Column, position: Column) -> Column:
    """Value of the byte at a 0-based position."""
    return F.conv(F.hex(F.substring(data, position + 1, F.lit(1))), 16, 10).cast("int")
