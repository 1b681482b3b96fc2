"""Near-duplicates by an inverted join over MinHash coordinates."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.llm.bloom import Filter
from newsmill.llm.common import Batch, bytes_lower, per_batch, strings
from newsmill.llm.graph import components
from newsmill.session import cut

# Coordinates of a signature, and the probability below which a pair at the least similarity is missed
# because it shares too few of them.
COORDINATES = 48
MISS = 1e-7
# Documents, and shingles, of a block: two blocks are compared with each other in one task.
BLOCK_DOCS = 512
BLOCK_SHINGLES = 400_000
# Clusters of more blocks than this are first thinned out by comparing every document with one centre per list.
FEW_BLOCKS = 4
# Rows of a posting list that are compared with each other in one task; of longer lists, pairs of blocks are.
LIST_ROWS = 32_768
# Lists of up to so many rows are compared side by side, longer ones one at a time.
SHORT_LIST = 256

_SHINGLE = "doc_id bigint, text_key bigint, n_shingles bigint, set_key binary, tokens array<bigint>"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles; a text with fewer words is one shingle."""
    found = bytes_lower(text)
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    width = min(words, n)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k : n - width + 1 + k])
    return np.unique(out)


def _factors(count: int) -> np.ndarray:
    return _mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def signature(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Per coordinate the smallest 32-bit value over the set, with the coordinate's number above it."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), 4096):
        block = hashes[start : start + 4096, None] * factors
        np.minimum(least, (block ^ (block >> np.uint64(29))).min(axis=0), out=least)
    return ((np.arange(len(factors), dtype=np.uint64) << np.uint64(32)) | (least >> np.uint64(32))).astype(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64), pa.int64()))


def signatures(docs: DataFrame, words: int, coordinates: int) -> DataFrame:
    def make() -> Batch:
        factors = _factors(coordinates)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(t, words) for t in strings(batch, "text")]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    _lists([signature(s, factors) if len(s) else np.empty(0, np.int64) for s in sets]),
                ],
                names=["doc_id", "text_key", "n_shingles", "set_key", "tokens"],
            )

        return one

    return per_batch(docs, make, _SHINGLE)


def _with_sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """``members`` with the shingle hashes of their documents. Texts of others are not shuffled."""
    names = [f.name for f in members.schema.fields if f.name != "doc_id"]

    def make() -> Batch:
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            kept = [batch.column(n) for n in ("doc_id", *names)]
            return pa.RecordBatch.from_arrays([*kept, _lists([shingles(t, words) for t in strings(batch, "text")])], names=["doc_id", *names, "hashes"])

        return one

    likely = Filter(members, "doc_id").mark(docs, F.col("doc_id"), "_nm_maybe").where("_nm_maybe").drop("_nm_maybe")
    schema = ", ".join(["doc_id bigint", *[f"{n} {members.schema[n].dataType.simpleString()}" for n in names], "hashes array<bigint>"])
    return per_batch(likely.join(members, "doc_id"), make, schema)


def _sketch(coordinates: int) -> list[Column]:
    """The last four bits of every coordinate, sixteen to a column. Coordinates that agree have them in common."""
    bits = [F.shiftleft(F.col("tokens")[k].bitwiseAND(15), 4 * (k % 16)) for k in range(coordinates)]
    return [reduce(Column.bitwiseOR, bits[k : k + 16]).alias(f"bits_{k // 16}") for k in range(0, coordinates, 16)]


def postings(heads: DataFrame, matches: int, coordinates: int) -> DataFrame:
    """Where documents are posted: a row per document with its sketch, the array ``token``, a token being a
    coordinate with its value, and beside it ``parts``, into how many blocks the list of the token is dealt.

    Two signatures that agree in ``matches`` coordinates share one of the ``coordinates - matches + 1``
    rarest tokens of each. So a document is posted under its rarest ones only, and of these only under
    such that another document has too. Values that many documents share, such as those of a common
    passage, come last in that order and are skipped, unless most of the document consists of them.
    """
    every = heads.select("doc_id", F.explode("tokens").alias("token"))
    counts = every.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    common = every.join(counts, "token").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("common"))
    room = F.lit(coordinates - matches + 1) - (F.lit(coordinates) - F.size("common"))
    rare = common.where(room > 0).select("doc_id", F.slice("common", F.lit(1), room).alias("rare"))
    parts = F.transform("rare", lambda t: F.ceil(t["n"] / LIST_ROWS).cast("int")).alias("parts")
    sketched = heads.select("doc_id", "n_shingles", *_sketch(coordinates))
    return rare.join(sketched, "doc_id").select(*sketched.columns, F.col("rare.token").alias("token"), parts)


def _alike(sizes: np.ndarray, bits: list[np.ndarray], a, b, least: int, percent: int) -> np.ndarray:
    """Whether the sketches of rows ``a`` and ``b`` differ in ``least`` coordinates at most and their sizes allow similarity."""
    differ = np.zeros(len(b), np.int64)
    for word in bits:
        x = word[a] ^ word[b]
        x |= x >> np.uint64(1)
        x |= x >> np.uint64(2)
        differ += np.bitwise_count(x & np.uint64(0x1111111111111111))
    return (differ <= least) & (100 * np.minimum(sizes[a], sizes[b]) >= percent * np.maximum(sizes[a], sizes[b]))


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the first one that it is connected with over the links ``a[k]``, ``b[k]``."""
    label = np.arange(n)
    while (label[a] != label[b]).any():
        one, other = label[a], label[b]
        np.minimum.at(label, np.maximum(one, other), np.minimum(one, other))
        while (label[label] != label).any():
            label = label[label]
    return label


def connected(lists: np.ndarray, sizes: np.ndarray, bits: list[np.ndarray], least: int, percent: int) -> np.ndarray:
    """For each row, ordered by list, the first of its list that it is connected with over rows with like sketches."""
    n = len(lists)
    edges = np.flatnonzero(np.diff(lists, prepend=lists[:1] - 1, append=lists[-1:] + 1)) if n else np.zeros(1, np.int64)
    lengths = np.diff(edges)
    short = np.repeat(lengths <= SHORT_LIST, lengths)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    at, step = np.flatnonzero(short), 1
    while len(at := at[at + step < n]) and len(at := at[lists[at] == lists[at + step]]):
        good = at[_alike(sizes, bits, at, at + step, least, percent)]
        found.append((good, good + step))
        step += 1
    for k in np.flatnonzero(lengths > SHORT_LIST):
        rest = np.arange(edges[k], edges[k + 1])
        while len(rest):  # what is reached from the first row that is left
            seed, queue, rest = rest[0], [rest[0]], rest[1:]
            while queue and len(rest):
                good = _alike(sizes, bits, queue.pop(), rest, least, percent)
                queue += (new := rest[good]).tolist()
                found.append((np.full(len(new), seed), new))
                rest = rest[~good]
    if not found:
        return np.arange(n)
    return _labels(n, *(np.concatenate(side) for side in zip(*found)))


def candidates(posted: DataFrame, matches: int, percent: int, coordinates: int) -> DataFrame:
    """Links ``(a, b)`` that connect all documents of a posting list whose sketches agree in ``matches`` coordinates,
    one a row at most, to the smallest id. Sharing the token of a list by chance links nothing.

    The rows of a list stand in sequence in one task, those of a list in several parts with those of another part.
    """
    words = [c for c in posted.columns if c.startswith("bits_")]
    rows = posted.select("doc_id", "n_shingles", *words, F.inline(F.arrays_zip("token", "parts")))
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int").alias("part")
    pairs = rows.select("*", part, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    key = F.when(F.col("parts") == 1, F.col("token")).otherwise(F.xxhash64("token", F.least("part", "other"), F.greatest("part", "other")))
    dealt = pairs.select(key.alias("list"), "doc_id", "n_shingles", *words).repartition("list").sortWithinPartitions("list", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: list[np.ndarray]) -> pa.RecordBatch:
            lists, ids, sizes, *bits = rows
            first = connected(lists, sizes, [w.view(np.uint64) for w in bits], coordinates - matches, percent)
            linked = first != np.arange(len(first))
            return pa.RecordBatch.from_arrays([pa.array(ids[linked], pa.int64()), pa.array(ids[first[linked]], pa.int64())], names=["a", "b"])

        held: list[np.ndarray] = []
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = [np.concatenate(c) for c in zip(held, new)] if held else new
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last list may go on
            if whole:
                yield found([c[:whole] for c in held])
                held = [c[whole:].copy() for c in held]
        if held:
            yield found(held)

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for lists in column.chunks:
        flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        out += [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
    return out


def shared_counts(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of ``sets[a[k]]`` and ``sets[b[k]]``. Few pairs are counted one by one, many
    as products of 0/1 matrices over stretches of the hashes that several sets hold."""
    if len(a) <= 2048:
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b)], np.int64)
    used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    row_of = np.repeat(np.arange(len(used)), [len(sets[u]) for u in used])
    _, column, held = np.unique(np.concatenate([sets[u] for u in used]), return_inverse=True, return_counts=True)
    several = held > 1  # a hash of one set is in no intersection
    rank = np.cumsum(several) - 1
    row_of, column = row_of[several[column]], rank[column[several[column]]]
    order = np.argsort(column, kind="stable")
    row_of, column = row_of[order], column[order]
    total, width = np.zeros((len(used), len(used)), np.float32), 4096
    edges = np.searchsorted(column, np.arange(0, int(several.sum()) + width, width))
    for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        part = np.zeros((len(used), width), np.float32)
        part[row_of[lo:hi], column[lo:hi] - k * width] = 1
        total += part @ part.T
    return np.rint(total[place[: len(a)], place[len(a) :]]).astype(np.int64)


def linked(ids, groups, blocks, tokens, sets, across: bool, matches: int, percent: int) -> list[tuple[int, int]]:
    """Links that connect documents of unlike groups: of all similar pairs as many as make a spanning forest.

    Pairs are counted over the coordinates first and confirmed on the full sets if ``matches`` agree;
    ``across`` leaves out pairs within one block, which are compared elsewhere.
    """
    values, sizes = np.vstack(tokens), np.array([len(x) for x in sets])
    equal = np.zeros((len(ids), len(ids)), np.int16)
    for c in range(values.shape[1]):
        equal += values[:, c, None] == values[None, :, c]
    hopeful = np.triu(equal >= matches, 1) & (groups[:, None] != groups[None, :])
    hopeful &= 100 * np.minimum(sizes[:, None], sizes[None, :]) >= percent * np.maximum(sizes[:, None], sizes[None, :])
    if across:
        hopeful &= blocks[:, None] != blocks[None, :]
    a, b = np.nonzero(hopeful)
    if not len(a):
        return []
    shared = shared_counts(sets, a, b)
    similar = 100 * shared >= percent * (sizes[a] + sizes[b] - shared)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for x, y in zip(a[similar], b[similar]):
        one, other = root(int(groups[x])), root(int(groups[y]))
        if one != other:
            parent[one] = other
            out.append((int(ids[x]), int(ids[y])))
    return out


def _compared(members: DataFrame, matches: int, percent: int) -> DataFrame:
    """Links within clusters. A cluster of ``blocks`` blocks is compared block by block, each pair of blocks
    in a task of its own, so that a task holds two blocks at most and no pair of documents is a row."""
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).alias("block")
    dealt = members.select("doc_id", "cluster", "component", "tokens", "hashes", block, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("other")

    def one(key: tuple, table: pa.Table) -> pa.Table:
        plain = {n: table.column(n).to_numpy() for n in ("doc_id", "component", "block")}
        across = key[1].as_py() != key[2].as_py()
        found = linked(plain["doc_id"], plain["component"], plain["block"], _arrays(table.column("tokens")), _arrays(table.column("hashes")), across, matches, percent)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return dealt.groupBy("cluster", "lo", "hi").applyInArrow(one, "a bigint, b bigint")


def _in_blocks(named: DataFrame) -> DataFrame:
    """Documents with the number of blocks of their cluster."""
    sizes = named.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_DOCS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("long")
    return named.join(sizes.select("cluster", blocks.alias("blocks")), "cluster")


def _starred(lists: DataFrame) -> DataFrame:
    """Each document of a posting list with the smallest one of the list."""
    centres = lists.groupBy("token").agg(F.min("doc_id").alias("b"))
    return lists.join(centres, "token").select(F.col("doc_id").alias("a"), "b").distinct()


def links(docs: DataFrame, heads: DataFrame, words: int, percent: int, coordinates: int, matches: int) -> DataFrame:
    """Links ``(a, b)`` between documents of different shingle sets, enough to connect all that are similar.

    Documents of a posting list with like sketches are connected, and what is connected forms a cluster; all
    similar pairs lie within clusters, and small clusters are compared at once. Documents that share values by
    chance are in no cluster, however many such lists there are in a large table. In a large cluster every
    document is first compared with the smallest one of each of its lists within the cluster, which connects
    most of a group of copies in a pass that is linear in its size. Documents of lists that hold more than one
    of these groups after that are compared by blocks, leaving out pairs within a group.
    """
    posted = cut(postings(heads, matches, coordinates))
    clusters = components(candidates(posted, matches, percent, coordinates)).withColumnsRenamed({"id": "doc_id", "component": "cluster"})
    members = cut(_in_blocks(clusters.join(heads, "doc_id")))
    small = members.where(F.col("blocks") <= FEW_BLOCKS)
    near = cut(_compared(_with_sets(docs, small, words).withColumn("component", F.col("doc_id")), matches, percent))
    large = members.where(F.col("blocks") > FEW_BLOCKS)
    if large.isEmpty():
        return near
    known = cut(_with_sets(docs, large.drop("blocks"), words))
    lists = posted.join(large.select("doc_id", "cluster").distinct(), "doc_id").select("doc_id", "cluster", F.explode("token").alias("token"))
    crowded = lists.select(F.xxhash64("token", "cluster").alias("token"), "doc_id")
    star = cut(_confirmed(_starred(crowded).where("a <> b"), known, matches, percent))
    # The smallest centre that a document is linked with stands for what is connected already.
    label = star.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "doc_id")
    named = crowded.join(label, "doc_id", "left").select("token", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    named = cut(named)
    apart = named.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    rest = named.join(apart.select("token"), "token", "left_semi").select("doc_id", "component").distinct()
    return near.unionAll(star).unionAll(_compared(_in_blocks(known.join(rest, "doc_id")), matches, percent))


def _confirmed(pairs: DataFrame, known: DataFrame, matches: int, percent: int) -> DataFrame:
    """Of ``(a, b)`` pairs those that agree in enough coordinates and whose full sets are similar."""
    side = lambda n: known.select(F.col("doc_id").alias(n), F.col("tokens").alias(f"{n}_tokens"), F.col("hashes").alias(f"{n}_hashes"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(F.size(F.array_intersect("a_tokens", "b_tokens")) >= matches)
    shared = F.size(F.array_intersect("a_hashes", "b_hashes"))
    return both.where(100 * shared >= percent * (F.size("a_hashes") + F.size("b_hashes") - shared)).select("a", "b")


def matches_for(percent: int, coordinates: int, miss: float = MISS) -> int:
    """How many coordinates two documents must share to be compared: as many as a pair at ``percent`` similarity
    falls short of with a probability below ``miss``, each being shared with that similarity; at least one."""
    p, short = percent / 100, 0.0
    for k in range(coordinates):
        short += math.comb(coordinates, k) * p**k * (1 - p) ** (coordinates - k)
        if short >= miss:
            return max(1, k)
    return coordinates


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
    coordinates: int = COORDINATES, matches: int | None = None,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``text_key``, ``n_shingles``, ``component_id``, ``kept``.

    Two documents are linked if the sets of their word shingles (A-Z lower-cased, ``words`` long) have a
    Jaccard similarity of ``percent`` / 100 or more; ``component_id`` is the smallest id reachable over
    links. Candidates come from MinHash signatures, every link is confirmed on the full sets.

    - Equal sets are linked by grouping, however many there are, and only one of them is compared on.
    - A text without words (or NULL) has ``n_shingles`` 0 and is linked with nothing. Fewer words than a
      shingle count as one shingle.
    - Rows that repeat an id are one document with all their links; ``text_key`` (a hash of the text) tells
      them apart. A row without an id is compared with nothing: ``component_id`` NULL, ``kept`` true.
    - Further columns of ``docs`` are ignored.
    """
    matches = matches_for(percent, coordinates) if matches is None else matches
    rows = docs.select(col(id_col).cast("bigint").alias("doc_id"), col(text_col).alias("text"))
    signed = cut(signatures(rows.withColumn("text_key", F.xxhash64("text")), words, coordinates))
    named = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    groups = cut(named.groupBy("set_key").agg(F.min(F.struct("doc_id", "tokens", "n_shingles")).alias("head")).select("set_key", "head.*"))
    near = links(rows.where("doc_id IS NOT NULL"), groups.select("doc_id", "tokens", "n_shingles"), words, percent, coordinates, matches)
    members = named.select(F.col("doc_id").alias("a"), "set_key").join(groups.select("set_key", F.col("doc_id").alias("b")), "set_key").where("a <> b")
    labels = components(near.unionAll(members.select("a", "b")))
    out = signed.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
