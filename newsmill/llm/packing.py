"""Sum-of-squares packing of tokenised documents into sequences of fixed capacity."""

from __future__ import annotations

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmill.columns import col
from newsmill.llm.common import Batch, per_batch, strings
from newsmill.llm.tokens import encoder
from newsmill.session import cut

CAPACITY = 1024
END_ID = 2
# Pieces that are packed together: one group is one call in one task. Larger groups waste less room, at
# this size about one part in a thousand.
GROUP_ROWS = 8192


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of whole documents, cut where longer than ``capacity``: ``doc_id``, ``piece`` from 0,
    ``start`` (ids before it), ``length``, ``ids`` (little-endian 32-bit numbers).

    Each document is its ids and ``end_id``. All pieces of a long one are full but the first. A NULL or
    empty text is one piece with the end id alone. Repeated rows are documents of their own, ids may be
    NULL, further columns are ignored. The vocabulary file must be readable where tasks run.
    """
    path = path or vocabulary()
    end = np.array([end_id], "<u4").tobytes()

    def make() -> Batch:
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[tuple] = []
            encode = encoder(path).encode
            for doc, text in zip(batch.column("doc_id").to_pylist(), strings(batch, "text")):
                ids = encode(text) + end
                n = len(ids) // 4
                first = (n - 1) % capacity + 1
                for k, stop in enumerate(range(first, n + 1, capacity)):
                    start = 0 if k == 0 else stop - capacity
                    out.append((doc, k, start, stop - start, ids[4 * start : 4 * stop]))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out) if out else [[]] * 5, types)], names=["doc_id", "piece", "start", "length", "ids"])

        return one

    rows = docs.select(col(id_col).cast("bigint").alias("doc_id"), col(text_col).alias("text"))
    return per_batch(rows, make, "doc_id bigint, piece int, start bigint, length bigint, ids binary")


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length.

    Longest first. ``bins[g]`` counts the open bins with a gap of ``g``; of the gaps that hold the item it
    takes the one after which the sum of squared counts is smallest, on ties the smallest. A new bin is
    opened if no open one holds the item; opening others as well costs 1 to 3 % more sequences.
    """
    bins = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bin_of, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        fits = bins[size:] > 0
        if fits.any():
            # Moving a bin from gap g to g - size changes the sum by 2 (bins[g - size] - bins[g] + 1);
            # filling it up (gap 0 is not open) by 1 - 2 bins[g].
            change = 2 * (bins[: capacity + 1 - size] - bins[size:] + 1)
            change[0] = 1 - 2 * bins[size]
            gap = size + int(np.argmin(np.where(fits, change, np.iinfo(np.int64).max)))
            bins[gap] -= 1
            chosen = stacks[gap].pop()
        else:
            gap, chosen = capacity, opened
            opened += 1
        bin_of[i], offset[i] = chosen, capacity - gap
        if gap > size:
            bins[gap - size] += 1
            stacks[gap - size].append(chosen)
    return bin_of, offset


def pack(items: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, length_col: str = "length") -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: gapless sequences of at most ``capacity``.

    Rows are dealt at random into groups of about ``group_rows`` and packed group by group, so that the
    work of a task is bounded however many rows there are and whatever their keys hold. The number of
    groups follows the number of rows. Lengths must lie between 1 and ``capacity``.
    """
    stored = cut(items)
    groups = max(1, -(-stored.count() // group_rows))
    dealt = stored.withColumn("_nm_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    fields = [f for f in stored.schema.fields]
    schema = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def one(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        bin_of, offset = place(group[length_col].to_numpy(np.int64), capacity)
        return group.drop(columns="_nm_group").assign(sequence_id=(int(key[0]) << 32) + bin_of, offset=offset)

    return dealt.groupBy("_nm_group").applyInPandas(one, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, starts``: the packed pieces put together, one row per sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    whole = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return whole.select("sequence_id", joined.alias("ids"), F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("starts"))
