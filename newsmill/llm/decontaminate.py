"""Benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

import re
from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.llm import bit_filter
from newsmill.llm.bloom import Filter
from newsmill.llm.common import Batch, per_batch, strings
from newsmill.session import cut

# Masks over word positions: 1 must agree, 0 is ignored. Five positions each: of random overlaps of 12 words with
# three changed they find 0.98, of 16 with four changed 0.99, of all longer ones with a quarter changed more.
MASKS = ("111011", "1100001011", "11010011")
# An overlap counts from so many words on (or the whole item if that is shorter) with this share equal.
MIN_WORDS = 12
MIN_EQUAL = 0.75
# Words around hits that an overlap may reach, and hits closer than this lie in one segment.
REACH = 48
# The filter that spares the join windows without a partner has at least 2^24 bits and at most 2^27 (16 MB).
FILTER_BITS = (24, 27)

_WORD = re.compile(r"\w+").findall


def word_hashes(text: str) -> np.ndarray:
    found = _WORD(text.lower())
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in found), np.uint64, len(found))


def windows(words: np.ndarray, masks: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every window under every mask."""
    hashes, starts = [], []
    for m, mask in enumerate(masks):
        n = len(words) - len(mask) + 1
        if n <= 0:
            continue
        h = np.full(n, m + 1, np.uint64)
        for k, use in enumerate(mask):
            if use == "1":
                h = (h ^ words[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(32)
        hashes.append(h)
        starts.append(np.arange(n))
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def _item_windows(items: DataFrame, masks: Sequence[str]) -> DataFrame:
    """``item_id, words, hash, at``: one row per window of an item; short items have none."""

    def make() -> Batch:
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, hashes, starts = [], [], []
            for item, text in zip(batch.column("item_id").to_pylist(), strings(batch, "text")):
                h, s = windows(word_hashes(text), masks)
                ids += [item] * len(h)
                hashes.append(h.view(np.int64))
                starts.append(s)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.concatenate([*hashes, np.empty(0, np.int64)]), pa.int64()), pa.array(np.concatenate([*starts, np.empty(0, np.int64)]).astype(np.int32))],
                names=["item_id", "hash", "at"],
            )

        return one

    return per_batch(items, make, "item_id bigint, hash bigint, at int")


def _segments(docs: DataFrame, masks: Sequence[str], table, reach: int) -> DataFrame:
    """Stretches of documents around windows that pass the filter, with their word hashes and windows."""
    schema = "row_key bigint, doc_id bigint, start int, words array<bigint>, hits array<struct<hash:bigint,at:int>>"

    def make() -> Batch:
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = {n: [] for n in ("row_key", "doc_id", "start", "words", "hits")}
            filled = table.value
            for key, doc, text in zip(batch.column("row_key").to_pylist(), batch.column("doc_id").to_pylist(), strings(batch, "text")):
                words = word_hashes(text)
                h, at = windows(words, masks)
                hit = np.flatnonzero(bit_filter.passing(h, [filled]))
                if not len(hit):
                    continue
                h, at = h[hit], at[hit]
                order = np.argsort(at, kind="stable")
                h, at = h[order].view(np.int64), at[order]
                for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > reach) + 1):
                    start = max(0, int(at[part[0]]) - reach)
                    out["row_key"].append(key)
                    out["doc_id"].append(doc)
                    out["start"].append(start)
                    out["words"].append(words[start : int(at[part[-1]]) + reach].view(np.int64))
                    out["hits"].append([{"hash": int(x), "at": int(p)} for x, p in zip(h[part], at[part])])
            types = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32())]))]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

        return one

    return per_batch(docs, make, schema)


def _whole(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all stretches of ``size`` words."""
    return windows(words, ["1" * size])[0] ^ np.uint64(size)


def _short_items(items: DataFrame, below: int) -> DataFrame:
    """``item_id, size, hash``: items with fewer words than ``below``, whole."""

    def make() -> Batch:
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), strings(batch, "text")):
                words = word_hashes(text)
                if 0 < len(words) < below:
                    rows.append((item, len(words), int(_whole(words, len(words)).view(np.int64)[0])))
            types = [pa.int64(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows) if rows else [[]] * 3, types)], names=["item_id", "size", "hash"])

        return one

    return per_batch(items, make, "item_id bigint, size int, hash bigint")


def _short_overlaps(docs: DataFrame, short: DataFrame) -> DataFrame:
    """Exact copies of short items. A document sends each stretch once, with its first place, however often it has it."""
    sizes = [r[0] for r in short.select("size").distinct().collect()]
    sent = docs.sparkSession.sparkContext.broadcast(bit_filter.build(short, "hash", FILTER_BITS))

    def make() -> Batch:
        table = sent.value

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for key, doc, text in zip(batch.column("row_key").to_pylist(), batch.column("doc_id").to_pylist(), strings(batch, "text")):
                words = word_hashes(text)
                for size in sizes:
                    hashes, first = np.unique(_whole(words, size), return_index=True)
                    hit = bit_filter.passing(hashes, [table])
                    out += [(key, doc, h, at) for h, at in zip(hashes[hit].view(np.int64).tolist(), first[hit].tolist())]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out) if out else [[]] * 4, types)], names=["row_key", "doc_id", "hash", "doc_start"])

        return one

    found = cut(per_batch(docs, make, "row_key bigint, doc_id bigint, hash bigint, doc_start int").distinct())
    sent.unpersist()
    size = F.col("size").cast("int")
    return found.join(short, "hash").select("row_key", "doc_id", "item_id", "doc_start", F.lit(0).alias("item_start"), size.alias("n_words"), size.alias("n_equal"))


def best_overlap(doc: np.ndarray, item: np.ndarray, shift: int, min_words: int, min_equal: float) -> tuple[int, int, int]:
    """``(item start, length, equal words)`` of the best stretch with ``item[i]`` against ``doc[i + shift]`` that
    has ``min_words`` or more words (or is the whole item) and a share of ``min_equal`` equal; else zeros.

    Equal words score ``1 - min_equal`` and others ``-min_equal``, so that a stretch scores zero or more if
    at least that share of it is equal. Only stretches that are long enough are compared, so that a short
    one of equal words hides none of them. Scores are whole numbers.
    """
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    least = max(1, min(min_words, len(item)))
    if hi - lo < least:
        return 0, 0, 0
    same = doc[lo + shift : hi + shift] == item[lo:hi]
    share = Fraction(str(min_equal))
    total = np.concatenate([[0], np.cumsum(np.where(same, share.denominator - share.numerator, -share.numerator))])
    rise = total[least:] - np.minimum.accumulate(total)[:-least]
    last = int(np.argmax(rise))
    if rise[last] < 0:
        return 0, 0, 0
    start, stop = int(np.argmin(total[: last + 1])), last + least
    return lo + start, stop - start, int(same[start:stop].sum())


def overlaps(
    docs: DataFrame, items: DataFrame, masks: Sequence[str] = MASKS, min_words: int = MIN_WORDS, min_equal: float = MIN_EQUAL, reach: int = REACH,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Overlaps of documents with benchmark items: ``row_key``, ``doc_id``, ``item_id``, ``doc_start``,
    ``item_start``, ``n_words``, ``n_equal``, at most one row (the largest overlap) per document and item.

    Words are runs of letters, digits and underscores, lower-cased. Every window of a document is hashed
    under each mask; windows that agree with one of an item (filter, then join on the hash) fix how the two
    lie against each other, and the words around are compared under that alignment, so that changed words
    in between do no harm. ``min_words`` or more words (or the whole item) must overlap with a share of
    ``min_equal`` equal.

    Items with fewer words than the shortest mask are found where all of their words stand one after the other.

    - NULL or empty texts and items without words overlap with nothing.
    - ``row_key`` is a hash of id and text: rows that repeat both give one row, rows without an id are
      searched like any other. Items that repeat an id count as one item. Further columns are ignored.
    """
    rows = docs.select(F.xxhash64(col(id_col), col(text_col)).alias("row_key"), col(id_col).cast("bigint").alias("doc_id"), col(text_col).alias("text"))
    named = items.select(col(item_col).cast("bigint").alias("item_id"), col(item_text_col).alias("text")).where("text IS NOT NULL")
    keyed = cut(_item_windows(named, masks).distinct())
    sent = docs.sparkSession.sparkContext.broadcast(bit_filter.build(keyed, "hash", FILTER_BITS))
    found = cut(_segments(rows, masks, sent, reach).dropDuplicates(["row_key", "start"]))
    sent.unpersist()
    hits = found.select("row_key", "start", F.inline("hits")).withColumnRenamed("at", "doc_at")
    shift = (F.col("doc_at") - F.col("start") - F.col("at")).alias("shift")
    ways = hits.join(keyed, "hash").select("row_key", "start", "item_id", shift).distinct()
    lay = ways.join(found.drop("hits"), ["row_key", "start"])
    item_words = named.select("item_id", F.col("text").alias("item_text"))
    long = _verified(lay.join(item_words, "item_id"), min_words, min_equal)
    short = cut(_short_items(named, min(map(len, masks))).distinct())
    return long if short.isEmpty() else long.unionByName(_short_overlaps(rows, short))


def _verified(laid: DataFrame, min_words: int, min_equal: float) -> DataFrame:
    def make() -> Batch:
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            columns = [batch.column(n).to_pylist() for n in ("row_key", "doc_id", "item_id", "start", "shift", "words", "item_text")]
            known: dict[str, np.ndarray] = {}
            for key, doc, item_id, start, shift, words, text in zip(*columns):
                item = known.get(text)
                if item is None:
                    item = known[text] = word_hashes(text)
                first, n, equal = best_overlap(np.array(words, np.int64).view(np.uint64), item, shift, min_words, min_equal)
                if n:
                    out.append((key, doc, item_id, start + shift + first, first, n, equal))
            names = ["row_key", "doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal"]
            types = [pa.int64()] * 3 + [pa.int32()] * 4
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out) if out else [[]] * 7, types)], names=names)

        return one

    verified = per_batch(laid, make, "row_key bigint, doc_id bigint, item_id bigint, doc_start int, item_start int, n_words int, n_equal int")
    rank = F.struct("n_equal", (-F.col("n_words")).alias("fewest"), (-F.col("doc_start")).alias("first"), (-F.col("item_start")).alias("item_first"))
    best = verified.groupBy("row_key", "doc_id", "item_id").agg(F.max(rank).alias("best"))
    return best.select(
        "row_key", "doc_id", "item_id", (-F.col("best.first")).alias("doc_start"), (-F.col("best.item_first")).alias("item_start"),
        (-F.col("best.fewest")).alias("n_words"), F.col("best.n_equal").alias("n_equal"),
    )


def clean_of(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that overlap with an item. Rows that a filter of the leaks rules out are
    not shuffled."""
    key, maybe = "_nm_row_key", "_nm_maybe"
    leaks = cut(found.select(F.col("row_key").alias(key)).distinct())
    marked = Filter(leaks, key).mark(docs.withColumn(key, F.xxhash64(col(id_col), col(text_col))), F.col(key), maybe)
    rest = marked.where(F.col(maybe)).join(leaks, key, "left_anti")
    return marked.where(~F.col(maybe)).unionByName(rest).select(*[col(c) for c in docs.columns])
