"""A blocked Bloom filter in SQL: one 64-bit word a block, four bits a key, 16 bits of filter for each key.

The words of ``SLICE`` blocks are one row, so a broadcast filter takes two bytes a key. Its size follows from a
count of the keys. Above ``BROADCAST_BYTES`` it is not broadcast: :func:`bloom_filter` is then joined by
slice like any other table, and :func:`possible` lets every row through to the exact join that follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_PER_BLOCK = 4
BITS_PER_KEY = 4
SLICE = 1 << 14
BROADCAST_BYTES = 64 << 20


def blocks_for(keys: int) -> int:
    """Blocks of a filter for so many keys: a power of two, 16 to 32 bits a key."""
    return 1 << max(0, (-(-keys // KEYS_PER_BLOCK) - 1).bit_length())


def broadcastable(blocks: int) -> bool:
    return 8 * blocks <= BROADCAST_BYTES


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def slice_of(key: Column, blocks: int) -> Column:
    return F.floor(_block(key, blocks) / SLICE).cast("int")


def mask(key: Column) -> Column:
    second = F.xxhash64(key, F.lit(1))
    bits = F.lit(0).cast("long")
    for k in range(BITS_PER_KEY):
        place = F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return bits


def holds(words: Column, key: Column, blocks: int) -> Column:
    """Whether the slice ``words`` of the key has all its bits: True for each key that went in."""
    word = F.get(words, F.pmod(_block(key, blocks), F.lit(SLICE)).cast("int"))
    return word.bitwiseAND(mask(key)) == mask(key)


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(slice, words) of the values of column ``key`` that are not NULL; every slice is there."""
    known = keys.filter(F.col(key).isNotNull())
    used = known.groupBy(_block(F.col(key), blocks).alias("block")).agg(F.bit_or(mask(F.col(key))).alias("bits"))
    every = used.unionByName(keys.sparkSession.range(blocks).select(F.col("id").alias("block"), F.lit(0).cast("long").alias("bits")))
    word = every.groupBy("block").agg(F.bit_or("bits").alias("bits"))
    rows = word.groupBy(F.floor(F.col("block") / SLICE).cast("int").alias("slice")).agg(F.sort_array(F.collect_list(F.struct("block", "bits"))).alias("rows"))
    return rows.select("slice", F.transform("rows", lambda r: r["bits"]).alias("words"))


def possible(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The ``rows`` whose columns ``on`` may be among ``keys``: less to shuffle for the exact join that follows.

    ``keys`` is counted, so pass a table. Let the exact join be an inner one, on distinct keys: the optimiser would push a
    semi join below this filter, and all rows would be shuffled.
    """
    blocks = blocks_for(keys.count())
    if not broadcastable(blocks):
        return rows
    hashed = keys.select(F.xxhash64(*on).alias("_td_key"))
    bits = F.broadcast(bloom_filter(hashed, "_td_key", blocks).toDF("_td_slice", "_td_words"))
    keyed = rows.withColumn("_td_key", F.xxhash64(*on)).withColumn("_td_slice", slice_of(F.col("_td_key"), blocks))
    return keyed.join(bits, "_td_slice").filter(holds(F.col("_td_words"), F.col("_td_key"), blocks)).select(*rows.columns)
