"""A blocked Bloom filter of bounded size as a table, so that rows without a partner need not be shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Filter bits per key, bits set for each, and the most 64-bit blocks a filter has (16 MB in all).
BITS_PER_KEY = 16
BITS_SET = 4
MAX_BLOCKS = 1 << 20


def _place(key: Column, blocks: int) -> tuple[Column, Column]:
    """Block of a key, and its bits within the block."""
    h, g = F.xxhash64(key), F.xxhash64(F.lit(7), key)
    mask = F.lit(0).cast("long")
    for k in range(BITS_SET):
        bit = F.shiftrightunsigned(g, 6 * k).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return F.pmod(h, F.lit(blocks)), mask


class Filter:
    """Of the keys in one column, which must be stored (the filter reads it twice): about ``BITS_PER_KEY``
    bits a key and never more than ``MAX_BLOCKS`` rows, however many keys there are."""

    def __init__(self, keys: DataFrame, name: str):
        self.blocks = min(MAX_BLOCKS, max(1, -(-keys.count() * BITS_PER_KEY // 64)))
        block, bits = _place(F.col(name), self.blocks)
        self.table = keys.select(block.alias("_nm_block"), bits.alias("_nm_bits")).groupBy("_nm_block").agg(F.bit_or("_nm_bits").alias("_nm_bits"))

    def mark(self, df: DataFrame, key: Column, name: str) -> DataFrame:
        """``df`` with a column that is false where the key is in no row of the filtered table (or NULL)."""
        block, bits = _place(key, self.blocks)
        joined = df.join(F.broadcast(self.table), block == F.col("_nm_block"), "left")
        held = F.coalesce(F.col("_nm_bits").bitwiseAND(bits) == bits, F.lit(False))
        return joined.withColumn(name, key.isNotNull() & held).drop("_nm_block", "_nm_bits")
