"""Operators on raw topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameweir.operators.joins import lookup_join
from frameweir.schema import ARRIVAL


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("null"))


def key_value_line() -> Column:
    """One printed line per record; a missing key or value prints `null`."""
    return F.concat(F.lit("Key: "), _text("key"), F.lit(";Value: "), _text("value"))


def first_of_batch(records: DataFrame) -> DataFrame:
    """The first record of each batch, by partition and offset; the others are
    skipped. The firsts are found on narrow columns and looked up, so that no
    payload is sorted or shuffled."""
    first = records.groupBy("batch_id").agg(F.min(F.struct(*ARRIVAL)).alias("first"))
    return lookup_join(records, first.select("batch_id", "first.*"), ["batch_id", *ARRIVAL], "left_semi")
