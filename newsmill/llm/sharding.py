"""Placement of documents on shards by a permutation-filled lookup table."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col

# Slots of the table: a prime, about a hundred or more per shard.
SLOTS = 65_537


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill(shards: Sequence[str], slots: int = SLOTS) -> np.ndarray:
    """The shard number of every slot.

    Each shard has a preference order over all slots, a permutation given by two hashes of its name (a
    start, and a step that is prime to ``slots``). The shards take turns; whoever's turn it is claims the
    first slot of its order that is still free. So shares differ by one slot at most, and without one
    shard nearly all other slots stay as they are. Order and repetition of ``shards`` make no difference.
    """
    names = sorted(set(shards))
    if not names or not is_prime(slots) or slots < len(names):
        raise ValueError("shards are needed, and a prime number of slots that is not below theirs")
    at = [xxhash.xxh3_64_intdigest(n, seed=1) % slots for n in names]
    step = [xxhash.xxh3_64_intdigest(n, seed=2) % (slots - 1) + 1 for n in names]
    owner = np.full(slots, -1, np.int32)
    for claimed in range(slots):
        s = claimed % len(names)
        while owner[at[s]] >= 0:
            at[s] = (at[s] + step[s]) % slots
        owner[at[s]] = s
    return owner


def slot_of(key: Column, otherwise: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; rows without one are spread by ``otherwise``."""
    return F.pmod(F.when(key.isNotNull(), F.xxhash64(key)).otherwise(F.xxhash64(otherwise)), F.lit(slots)).cast("int")


def place(docs: DataFrame, shards: Sequence[str], slots: int = SLOTS, key: str = "doc_id", spread_by: str = "text") -> DataFrame:
    """``doc_id``, ``slot``, ``shard``, one row per input row.

    The table has ``slots`` rows, whatever the data; it is broadcast, and no document is shuffled. Equal
    keys have one shard. A NULL key is placed by a hash of ``spread_by``, so that rows without a key do not
    meet in one shard (they do if that is NULL as well). Further columns are ignored.
    """
    owner, names = fill(shards, slots), sorted(set(shards))
    table = docs.sparkSession.createDataFrame([(i, names[s]) for i, s in enumerate(owner.tolist())], "slot int, shard string")
    rows = docs.select(col(key).alias("doc_id"), slot_of(col(key), col(spread_by), slots).alias("slot"))
    return rows.join(F.broadcast(table), "slot").select("doc_id", "slot", "shard")


def write_shards(docs: DataFrame, path: str, shards: Sequence[str], slots: int = SLOTS, key: str = "doc_id", spread_by: str = "text", files_per_shard: int = 8) -> None:
    """``docs`` as Parquet, one folder per shard; a shard is written by ``files_per_shard`` tasks, each of
    which takes part of its slots."""
    owner, names = fill(shards, slots), sorted(set(shards))
    table = docs.sparkSession.createDataFrame([(i, names[s]) for i, s in enumerate(owner.tolist())], "_nm_slot int, shard string")
    placed = docs.withColumn("_nm_slot", slot_of(col(key), col(spread_by), slots)).join(F.broadcast(table), "_nm_slot")
    spread = placed.repartition(len(names) * files_per_shard, "shard", F.pmod("_nm_slot", F.lit(files_per_shard)))
    spread.drop("_nm_slot").write.partitionBy("shard").parquet(path)
