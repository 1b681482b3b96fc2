"""The keys of a stored table, kept beside it: by hash range, and as a filter of bounded size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.sources.files import exists

# 64-bit blocks of a filter (8 MB at most), bits set per key, and hash ranges of the keys.
BLOCKS = 1 << 20
BITS_SET = 4
RANGES = 64


def _hash(keys: Sequence[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[col(k) for k in keys])


class Keys:
    """Keys stored at ``path``, one folder per batch; with ``before`` only those of earlier batches count."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], blocks: int = BLOCKS, before: int | None = None):
        self.spark, self.path, self.keys, self.blocks, self.before = spark, path, list(keys), blocks, before

    def _range(self) -> Column:
        return F.pmod(_hash(self.keys, 0), F.lit(RANGES)).cast("int")

    def _place(self) -> tuple[Column, Column]:
        h = _hash(self.keys, 2)
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(63).cast("int")) for k in range(BITS_SET)]
        return F.pmod(_hash(self.keys, 1), F.lit(self.blocks)), reduce(lambda a, b: a.bitwiseOR(b), bits)

    def _read(self, part: str) -> DataFrame | None:
        folder = f"{self.path}/{part}"
        if not exists(self.spark, folder):
            return None
        rows = self.spark.read.parquet(folder)
        return rows if self.before is None else rows.where(F.col("batch") < self.before)

    def missing_from(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is not stored."""
        filters = self._read("filter")
        if filters is None:
            return rows
        # At most ``blocks`` rows of 16 bytes.
        table = filters.groupBy("block").agg(F.bit_or("bits").alias("bits"))
        block, bits = self._place()
        marked = rows.withColumns({"_nm_block": block, "_nm_bits": bits, "_nm_range": self._range()})
        marked = marked.join(F.broadcast(table.withColumnsRenamed({"block": "_nm_block", "bits": "_nm_held"})), "_nm_block", "left")
        possible = F.coalesce(F.col("_nm_held").bitwiseAND(F.col("_nm_bits")) == F.col("_nm_bits"), F.lit(False))
        helpers = ["_nm_block", "_nm_bits", "_nm_held", "_nm_range"]
        maybe = marked.where(possible)
        ranges = [r[0] for r in maybe.select("_nm_range").distinct().collect()]
        stored = self._read("keys").where(F.col("range").isin(ranges)).select(*[col(k) for k in self.keys])
        return marked.where(~possible).drop(*helpers).unionByName(maybe.drop(*helpers).join(stored, self.keys, "left_anti"))

    def add(self, rows: DataFrame, batch: int) -> None:
        """Stores the keys of a batch; what an earlier attempt at it has stored is replaced."""
        block, bits = self._place()
        filled = rows.select(block.alias("block"), bits.alias("bits")).groupBy("block").agg(F.bit_or("bits").alias("bits"))
        filled.write.mode("overwrite").parquet(f"{self.path}/filter/batch={batch}")
        laid = rows.select(*[col(k) for k in self.keys], self._range().alias("range")).repartition("range")
        laid.write.mode("overwrite").partitionBy("range").parquet(f"{self.path}/keys/batch={batch}")
