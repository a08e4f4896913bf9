"""Column functions for time text, file names and camera addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters a list entry is trimmed of: everything up to the blank.
BLANKS = "".join(chr(code) for code in range(33))

# Largest device index.
MAX_DEVICE = 2**31 - 1


def wall_clock() -> Column:
    """The time at which each row is handled. Spark's `current_timestamp` is one
    time for a whole query, which would give all its frames one name."""
    millis = F.reflect(F.lit("java.lang.System"), F.lit("currentTimeMillis"))
    return F.timestamp_millis(millis.cast("bigint"))


def stamp_text(at: Column | None = None) -> Column:
    """Time as `yyyy-MM-dd HH:mm:ss.f`: whole milliseconds, trailing zeros cut,
    at least one digit. Takes the wall clock when no column is given; a given
    column makes a run repeatable."""
    if at is None:
        # A lambda's variable is read once, however often it is used: seconds
        # and milliseconds come from one look at the clock.
        return F.get(F.transform(F.array(wall_clock()), stamp_text), F.lit(0))
    text = at.cast("string")
    # The cast drops trailing zeros already, but only of the microseconds.
    millis = F.rtrim(F.substring(F.split_part(text, F.lit("."), F.lit(2)), 1, 3), F.lit("0"))
    return F.concat(
        F.split_part(text, F.lit("."), F.lit(1)),
        F.lit("."),
        F.when(millis == "", "0").otherwise(millis),
    )


def _path(folder: str, camera: Column, stamp: Column) -> Column:
    return F.concat(F.lit(folder), camera, F.lit("-T-"), stamp, F.lit(".png"))


def file_name(folder: str, camera: Column, stamp: Column) -> Column:
    """Image path with a cleaned time: blanks, dots and colons become dashes.
    No separator is put after `folder`."""
    return _path(folder, camera, F.translate(F.regexp_replace(stamp, r"\s+", "-"), ".:", "--"))


def raw_file_name(folder: str, camera: Column, stamp: Column) -> Column:
    """Image path with the time text as it came."""
    return _path(folder, camera, stamp)


def list_entries(text: Column) -> Column:
    """The entries of a comma-separated list, trimmed. Empty entries at the
    end do not count; an empty text is one empty entry."""
    body = F.regexp_replace(text, r",+\z", "")
    entries = (
        F.when(text == "", F.array(F.lit("")))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, ","))
    )
    return F.transform(entries, lambda entry: F.trim(entry, F.lit(BLANKS)))


def address_kind(address: Column) -> Column:
    """`device` for a device index, `url` for a URL or path, and `invalid`
    for digits that give no index (none at all, or too large)."""
    digits = address.rlike(r"\A[0-9]*\z")
    index = address.try_cast("decimal(38,0)")
    return (
        F.when(~digits, "url")
        .when(index.isNotNull() & (index <= MAX_DEVICE), "device")
        .otherwise("invalid")
    )
