"""Joining a large table to a table expected to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameweir.session import stored

# Largest table that is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024


def table_bytes(df: DataFrame) -> int:
    """Size of a table as text, an upper guide for its size in memory."""
    size = df.select(F.octet_length(F.to_json(F.struct("*"))).cast("bigint").alias("n"))
    return size.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "left",
    limit: int = BROADCAST_BYTES,
    is_stored: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """Join of `big` to `small`, which has one row per `keys`; `how` is left, inner,
    left_semi or left_anti.

    `small` is computed (unless it is a stored table) and measured first, in
    `folder` if one is given, which is overwritten. Up to `limit` bytes it is
    broadcast, so that `big` does not move. Beyond that both sides are shuffled
    by the keys; the rows of a hot key are on the side of `big` only, where the
    adaptive skew join splits them.
    """
    if not is_stored:
        small = stored(small, "lookup", folder)
    small = F.broadcast(small) if table_bytes(small) <= limit else small.hint("merge")
    return big.join(small, keys, how)
