"""The 32-bit hash by which message brokers' default partitioner deals keys, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seed, multiplier, shift and the final shifts of MurmurHash2 (32 bits).
SEED, MULTIPLIER, SHIFT = 0x9747B28C, 0x5BD1E995, 24
FINAL_SHIFTS = (13, 15)
MASK = 0xFFFFFFFF


def _times(value: Column) -> Column:
    # Below 2^32 times below 2^31: no overflow of a long.
    return (value * F.lit(MULTIPLIER)).bitwiseAND(F.lit(MASK))


def _little_endian(digits: Column, size: int) -> Column:
    """The first ``size`` bytes of a hexadecimal string as an unsigned number, least byte first."""
    pairs = [F.substring(digits, 2 * k + 1, 2) for k in reversed(range(size))]
    return F.conv(F.concat(*pairs), 16, 10).cast("long")


def murmur2(key: Column) -> Column:
    """Unsigned 32-bit hash of a string's UTF-8 bytes, as a long; null for null."""
    digits = F.hex(F.encode(key, "UTF-8"))
    size = F.octet_length(key)
    words = F.regexp_extract_all(digits, F.lit("(.{8})"), F.lit(1))

    def mixed(h: Column, word: Column) -> Column:
        k = _times(_little_endian(word, 4))
        k = _times(k.bitwiseXOR(F.shiftright(k, SHIFT)))
        return _times(h).bitwiseXOR(k)

    h = F.aggregate(words, F.lit(SEED).cast("long").bitwiseXOR(size.cast("long")), mixed)
    rest = F.substring(digits, F.floor(size / 4).cast("int") * 8 + 1, F.lit(6))

    def tail(n: int) -> Column:
        return _times(h.bitwiseXOR(_little_endian(rest, n)))

    left = size % 4
    h = F.when(left == 3, tail(3)).when(left == 2, tail(2)).when(left == 1, tail(1)).otherwise(h)
    h = _times(h.bitwiseXOR(F.shiftright(h, FINAL_SHIFTS[0])))
    return h.bitwiseXOR(F.shiftright(h, FINAL_SHIFTS[1]))


def key_partition(key: Column, partitions: int) -> Column:
    """Partition of a key: the hash without its sign bit, modulo the number of partitions."""
    return (murmur2(key).bitwiseAND(F.lit(0x7FFFFFFF)) % F.lit(partitions)).cast("int")
