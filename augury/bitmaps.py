"""A bounded map of bits that spares rows a join they would not survive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from augury.session import freeze

BITS = 1 << 23
#: Bits that one value of ``bitmap_construct_agg`` holds.
_BUCKET_BITS = 32768


def packed_bits(keys: DataFrame, hashed: Column, bits: int) -> bytes:
    """A bit for each hash: never more than ``bits`` of them reach the driver."""
    position = F.pmod(hashed, F.lit(bits)) + 1  # the functions below count from 1
    found = (
        keys.select(position.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bytes"))
        .collect()
    )
    width = _BUCKET_BITS // 8
    out = bytearray(max(bits // 8, width))
    for row in found:
        at = (row["bucket"] - 1) * width
        out[at : at + width] = row["bytes"]
    return bytes(out[: bits // 8])


def bit_map(keys: DataFrame, *columns: str, bits: int = BITS) -> bytes:
    """A bit for each key, 1 MB in all however many keys there are."""
    return packed_bits(keys, F.xxhash64(*columns), bits)


def may_be_in(packed: bytes, *columns: str | Column) -> Column:
    """False only for keys that are not in the map. Equality is for the join that follows."""
    position = F.pmod(F.xxhash64(*columns), F.lit(len(packed) * 8))
    byte = F.substring(F.lit(packed), (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.getbit(value, F.pmod(position, F.lit(8)).cast("int")) == 1


def map_table(keys: DataFrame, hashed: Column, bits: int = BITS) -> DataFrame:
    """The map as a table of its buckets, to be sent to every task.

    As a literal its megabytes would be spelled out in every plan that reads the rows, and the
    driver keeps a text of each plan.
    """
    position = F.pmod(hashed, F.lit(bits)) + 1
    return freeze(
        keys.select(position.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("_map_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_map_bits"))
    )


def meet(rows: DataFrame, buckets: DataFrame, hashed: Column, how: str, bits: int = BITS) -> DataFrame:
    """Rows by a :func:`map_table`: those that may be in it (``left_semi``) or are not (``left_anti``).

    Between them the two have every row once, also one with a null hash.
    """
    position = F.pmod(hashed, F.lit(bits)) + 1
    at = F.bitmap_bit_position(position)
    byte = F.substring(F.col("_map_bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))
    hit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(at, F.lit(8)).cast("int")) == 1
    same = F.bitmap_bucket_number(position) == F.col("_map_bucket")
    return rows.join(F.broadcast(buckets), same & hit, how)


def may_pass(rows: DataFrame, keys: DataFrame, *columns: str, bits: int = BITS) -> DataFrame:
    """The rows whose key may be among ``keys``; others are left out, but for a few."""
    hashed = F.xxhash64(*columns)
    return meet(rows, map_table(keys, hashed, bits), hashed, "left_semi", bits)
