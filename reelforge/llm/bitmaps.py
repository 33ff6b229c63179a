"""A set of keys as a bitmap of fixed size: rows that cannot match are left out before a shuffle.

The bitmap has ``BITS`` bits (8 MB) whatever the number of keys, so it can be broadcast at any size of the input. It
never loses a key; with very many keys it lets more rows through, and the exact join behind it settles the rest.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26
CHUNK = 4096 * 8  # bits of one value of bitmap_construct_agg


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def bitmap_of(keys: DataFrame, key: str) -> DataFrame:
    """At most ``BITS / CHUNK`` rows: ``_chunk`` and its bits."""
    return (
        keys.select(_slot(F.col(key)).alias("_slot"))
        .groupBy(F.floor(F.col("_slot") / CHUNK).alias("_chunk"))
        .agg(F.bitmap_construct_agg(F.col("_slot") % CHUNK).alias("_bits"))
    )


def may_hold(rows: DataFrame, bitmap: DataFrame, key: Column) -> DataFrame:
    """The rows whose key may be in the bitmap; all rows whose key is in it are among them."""
    slot = _slot(key)
    at = slot % CHUNK
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (at % 8).cast("int")) == 1
    return (
        rows.withColumn("_chunk", F.floor(slot / CHUNK)).join(F.broadcast(bitmap), "_chunk").where(hit)
        .drop("_chunk", "_bits")
    )
