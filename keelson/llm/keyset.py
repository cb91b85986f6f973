"""A fixed-size set of keys for pre-filtering a large table.

A key set is a bitmap of ``bits`` bits (8 MB by default, whatever the data)
built by Spark from the keys and broadcast as rows of 4 KB. It may say yes for
a key that is not in the set, never no for one that is, so it only saves
shuffling; the exact join or grouping follows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26


def _slot(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0x5EED)), F.lit(bits))


def _free(name: str, rows: DataFrame) -> str:
    """``name``, longer until no column of ``rows`` has it."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _bit(position: Column, bitmap: str = "__bitmap") -> Column:
    """The bit of the bitmap at ``position`` (0 to 32767)."""
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, F.pmod(position, F.lit(8)).cast("int")).bitwiseAND(1)


def build(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """At most ``bits / 32768`` rows of 4 KB: the bitmap of the keys' slots."""
    slot = keys.select(_slot(F.col(key), bits).alias("__slot"))
    return slot.groupBy(F.bitmap_bucket_number("__slot").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__slot")).alias("__bitmap")
    )


def _probed(rows: DataFrame, slot: Column, bitmap: DataFrame, how: str) -> tuple[DataFrame, Column]:
    """``rows`` with the bitmap's part for their slot, and the bit there."""
    bucket, bits = _free("__bucket", rows), _free("__bitmap", rows)
    shared = bitmap.select(F.col("__bucket").alias(bucket), F.col("__bitmap").alias(bits))
    probed = rows.withColumn(bucket, F.bitmap_bucket_number(slot)).join(F.broadcast(shared), bucket, how)
    return probed, _bit(F.bitmap_bit_position(slot), bits)


def maybe_in(rows: DataFrame, key: str, bitmap: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows whose key may be in the set (all that are, and a few that are not)."""
    probed, bit = _probed(rows, _slot(F.col(key), bits), bitmap, "inner")
    return probed.filter(bit != 0).select(*rows.columns)


def without(rows: DataFrame, key: str, dropped: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows whose key is not in ``dropped (key)``; null keys stay.

    Rows that cannot be dropped pass at the scan; only those the bitmap is
    unsure of are joined.
    """
    unsure, sure = split(rows, key, dropped, bits)
    # An outer join, as Spark would push an anti join below the bitmap's and shuffle every row.
    name = _free("__gone", rows)
    gone = dropped.select(F.col(key).alias(name)).distinct()
    left = unsure.join(gone, F.col(key) == F.col(name), "left").filter(F.col(name).isNull()).select(*rows.columns)
    return sure.unionByName(left)


def split(rows: DataFrame, key: str, keys: DataFrame, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those whose key may be in ``keys (key)``, and those whose key is not."""
    probed, bit = _probed(rows, _slot(F.col(key), bits), build(keys, key, bits), "left")
    hit = F.coalesce(bit != 0, F.lit(False))
    return probed.filter(hit).select(*rows.columns), probed.filter(~hit).select(*rows.columns)
