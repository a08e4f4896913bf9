"""Choosing rows of a stored table by where they lie, without moving them."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameweir.functions.frames import byte_at
from frameweir.operators.joins import BROADCAST_BYTES
from frameweir.session import stored

POSITION = ["_file", "_row"]


def with_positions(table: DataFrame) -> DataFrame:
    """A table that is read from files, with the file of each row and its number there."""
    return table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def position_sets(rows: DataFrame) -> DataFrame:
    """(_file, _block, _bits): the positions of `rows` as one bit per row, 4 kB for
    each 32,768 rows of a file that has some of them."""
    number = F.col("_row") + 1
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits")
    return rows.groupBy("_file", F.bitmap_bucket_number(number).alias("_block")).agg(bits)


def _inside() -> Column:
    place = F.bitmap_bit_position(F.col("_row") + 1)
    byte = byte_at(F.col("_bits"), F.floor(place / 8).cast("int"))
    bit = F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1))
    return F.coalesce(bit == 1, F.lit(False))


def rows_by_position(
    table: DataFrame, rows: DataFrame, inside: bool, limit: int = BROADCAST_BYTES, folder: str | None = None
) -> DataFrame:
    """The rows of `table` that are among the positions of `rows` (or, if not `inside`,
    those that aren't). Both have the columns of `with_positions`.

    Rows are tested in the task that reads them. The sets are a bit per row of
    the table at most, so a broadcast of `limit` bytes does for half a thousand
    million rows; beyond that the files are dealt to groups by their names, and
    each group is read with its own sets only. Nothing of `table` is shuffled
    at any size.
    """
    sets = stored(position_sets(rows), "positions", folder)
    size = F.sum(F.octet_length("_bits") + F.octet_length("_file"))
    found = sets.agg(F.count_distinct("_file").alias("files"), F.coalesce(size, F.lit(0)).alias("bytes")).first()
    parts = max(1, min(found.files, ceil(found.bytes / max(1, limit))))

    def part(name: str | Column, k: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(parts)) == k

    chosen = []
    for k in range(parts):
        own, of = (table, sets) if parts == 1 else (table.where(part("_file", k)), sets.where(part("_file", k)))
        block = F.bitmap_bucket_number(F.col("_row") + 1)
        joined = own.withColumn("_block", block).join(F.broadcast(of), ["_file", "_block"], "left")
        chosen.append(joined.where(_inside() if inside else ~_inside()).select(*table.columns))
    whole = chosen[0]
    for more in chosen[1:]:
        whole = whole.unionByName(more)
    return whole
