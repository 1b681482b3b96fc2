"""A bit filter over 64-bit hashes for numpy code in tasks: false positives, never false negatives."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.llm.common import Batch, per_batch

# Bits per hash, of which one is set for each probe.
BITS_PER_HASH = 64
PROBES = tuple(np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407))


def build(hashes: DataFrame, name: str, bits: tuple[int, int]) -> np.ndarray:
    """The filter of a column of a stored table, with a power of two of bits between the given ones. The driver
    gets its filled 64-bit words, never the hashes."""
    size = min(bits[1], max(bits[0], (BITS_PER_HASH * hashes.count()).bit_length()))

    def make() -> Batch:
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            h = batch.column("hash").to_numpy(zero_copy_only=False).view(np.uint64)
            slots = np.concatenate([(h * f) >> np.uint64(64 - size) for f in PROBES])
            masks = np.uint64(1) << (slots & np.uint64(63))
            return pa.RecordBatch.from_arrays([pa.array((slots >> np.uint64(6)).astype(np.int64)), pa.array(masks.view(np.int64))], names=["w", "m"])

        return one

    filled = per_batch(hashes.select(F.col(name).alias("hash")), make, "w bigint, m bigint").groupBy("w").agg(F.bit_or("m").alias("m")).toPandas()
    table = np.zeros(1 << (size - 6), np.uint64)
    table[filled["w"].to_numpy(np.int64)] = filled["m"].to_numpy(np.int64).view(np.uint64)
    return table


def passing(h: np.ndarray, tables: Sequence[np.ndarray]) -> np.ndarray:
    """Whether each hash is possibly in one of the filters."""
    found = np.zeros(len(h), bool)
    for table in tables:
        shift = np.uint64(64 - 6 - (len(table).bit_length() - 1))
        at = np.flatnonzero(~found)
        for f in PROBES:
            slot = (h[at] * f) >> shift
            at = at[((table[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)]
        found[at] = True
    return found
