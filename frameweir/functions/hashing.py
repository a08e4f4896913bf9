"""The partition of a keyed record, as brokers' clients choose it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the 32-bit hash: seed, factor, shifts.
SEED, FACTOR, SHIFT, LAST_SHIFTS = 0x9747B28C, 0x5BD1E995, 24, (13, 15)

_WORD = 0xFFFFFFFF


def _times(value: Column) -> Column:
    """Product with FACTOR in 32 bits; both are below 2**32, so 64 bits hold it."""
    return (value * F.lit(FACTOR)).bitwiseAND(F.lit(_WORD))


def _fold(value: Column, bits: int) -> Column:
    return value.bitwiseXOR(F.shiftrightunsigned(value, bits))


def _number(digits: Column, first: Column, count: int) -> Column:
    """The `count` bytes from byte `first` of a text of hex digits, lowest byte first."""
    parts = [F.substring(digits, first * 2 + 1 + 2 * k, F.lit(2)) for k in reversed(range(count))]
    return F.conv(F.concat(*parts), 16, 10).cast("bigint")


def _once(value: Column, use) -> Column:
    """`use` of a value that is used more than once: a lambda's variable is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def key_hash(key: Column) -> Column:
    """The hash of a binary key, from 0 to 2**32 - 1; null for a null key."""
    size = F.octet_length(key).cast("bigint")
    words, rest = F.floor(size / 4), size % 4
    places = F.when(words > 0, F.sequence(F.lit(0).cast("bigint"), words - 1)).otherwise(F.array().cast("array<bigint>"))

    def of(digits: Column) -> Column:
        def step(h: Column, k: Column) -> Column:
            return _times(h).bitwiseXOR(_times(_once(_times(_number(digits, k * 4, 4)), lambda x: _fold(x, SHIFT))))

        def finish(h: Column) -> Column:
            tail = F.lit(0).cast("bigint")
            for count in (1, 2, 3):
                tail = F.when(rest == count, _number(digits, words * 4, count)).otherwise(tail)
            h = F.when(rest > 0, _times(h.bitwiseXOR(tail))).otherwise(h)
            return _once(_once(h, lambda x: _times(_fold(x, LAST_SHIFTS[0]))), lambda x: _fold(x, LAST_SHIFTS[1]))

        return F.aggregate(places, F.lit(SEED).bitwiseXOR(size), step, finish)

    return _once(F.hex(key), of)


def key_partition(key: Column, partitions: int | Column) -> Column:
    """The partition of a keyed record; null without a key, as then the client deals
    records out by its own rule."""
    return (key_hash(key).bitwiseAND(F.lit(0x7FFFFFFF)) % (F.lit(partitions) if isinstance(partitions, int) else partitions)).cast("int")
