"""Phrases of a corpus: fingerprints of all n-grams from prefix polynomials, counted by shuffles."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.llm import bit_filter
from newsmill.llm.common import SLICE_ROWS, strings
from newsmill.session import broadcast_if_small, cut

# Phrases of up to so many words count from so many occurrences on.
MAX_WORDS = 4
MIN_COUNT = 30
# A phrase is dropped if a longer candidate around it has this share of its occurrences, in percent.
INSIDE_PERCENT = 80
SCALE = 2_000_000
TOP = 2_000
# Bytes that are hashed at a time, fingerprints and phrases that a task holds before it sends them on.
CHUNK_BYTES = 1 << 20
HELD_FINGERPRINTS = 1_500_000
HELD_PHRASES = 1_000_000
# Rows of a batch on the way to the shuffle.
SENT_ROWS = 1 << 17
# Size of a filter of frequent fingerprints as a power of two in bits: 2^20 to 2^27 (16 MB). Beyond that it lets
# more pass; the counts stay exact.
FILTER_BITS = (20, 27)
# One-word parts begin or end many candidates: candidates are dealt to so many parts, which all have them.
SALTS = 16

# One table lowers A-Z, makes a line end of what ends a piece, and a blank of a tab.
_TRANSLATE = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
_BASE, _OTHER_BASE, _WORD_BASE = 0xD1B54A32D192ED03, 0xA0761D6478BD642F, 0x9E3779B97F4A7C15


def _powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** k`` modulo 2^64 and its inverse for each ``k`` below ``count``."""
    out = []
    for factor in (base, pow(base, -1, 1 << 64)):
        steps = np.full(count, factor, np.uint64)
        steps[:1] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


class Hasher:
    """Rabin-Karp fingerprints: with prefix sums ``S`` of values times powers of the base, the span from ``i`` to
    ``j`` has the polynomial ``(S[j] - S[i]) / base ** i``, wherever it stands."""

    def __init__(self) -> None:
        self.size, self.tables = 0, {}

    def spans(self, values: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int) -> np.ndarray:
        if len(values) > self.size:
            self.size, self.tables = max(len(values), CHUNK_BYTES), {}
        if base not in self.tables:
            self.tables[base] = _powers(base, self.size)
        up, down = self.tables[base]
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], dtype=np.uint64, out=sums[1:])
        return (sums[stop] - sums[start]) * down[start]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Chunk:
    """Words of some documents: their bytes in ``raw``, the piece and the document each belongs to, and a hash."""

    raw: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    piece: np.ndarray
    doc: np.ndarray
    word: np.ndarray
    seed: np.ndarray
    begin: np.ndarray
    hasher: Hasher

    def within(self, n: int) -> np.ndarray:
        """Whether the ``n`` words from each place on belong to one piece."""
        last = len(self.piece) - n + 1
        out = np.zeros(len(self.piece), bool)
        if last > 0:
            out[:last] = self.piece[:last] == self.piece[n - 1 :]
        return out

    def fingerprints(self, n: int, at: np.ndarray) -> np.ndarray:
        """Of the ``n`` words from each place of ``at`` on; language and length are part of it."""
        h = self.word[at] if n == 1 else self.hasher.spans(self.word, at, at + n, _WORD_BASE)
        return _mixed(h ^ (self.seed[at] * np.uint64(2 * n + 1)))

    def others(self, at: np.ndarray) -> np.ndarray:
        """A second hash of single words, from another base."""
        return _mixed(self.hasher.spans(self.raw.astype(np.uint64) + np.uint64(1), self.start[at], self.stop[at], _OTHER_BASE) + self.seed[at])

    def phrase(self, at: int, n: int) -> bytes:
        return b" ".join(self.raw[self.start[k] : self.stop[k]].tobytes() for k in range(at, at + n))


def chunk(texts: list[bytes], seeds: list[int], hasher: Hasher) -> Chunk:
    """The words of some texts; no piece reaches from one text into the next."""
    raw = np.frombuffer(b"\n".join(texts).translate(_TRANSLATE), np.uint8)
    ends = raw == 10
    edge = np.diff((ends | (raw == 32)).astype(np.int8), prepend=1, append=1)
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    doc = np.searchsorted(firsts, start, "right") - 1
    word = _mixed(hasher.spans(raw.astype(np.uint64) + np.uint64(1), start, stop, _BASE) + (stop - start).astype(np.uint64))
    return Chunk(raw, start, stop, np.cumsum(ends)[start], doc, word, np.array(seeds, np.uint64)[doc], firsts, hasher)


def _parts(text: bytes) -> Iterator[tuple[int, bytes]]:
    """A text in parts of about ``CHUNK_BYTES``, cut where a piece ends; the offset of each part."""
    start = 0
    while len(text) - start > CHUNK_BYTES:
        marks = np.flatnonzero(np.frombuffer(text[start : start + CHUNK_BYTES].translate(_TRANSLATE), np.uint8) == 10)
        if not len(marks):  # one long piece stays whole up to its end
            rest = text[start + CHUNK_BYTES :].translate(_TRANSLATE).find(b"\n")
            if rest < 0:
                break
            stop = start + CHUNK_BYTES + rest + 1
        else:
            stop = start + int(marks[-1]) + 1
        yield start, text[start:stop]
        start = stop
    yield start, text[start:]


Owner = tuple[str, object, int]


def _by_id(owner: Owner) -> tuple:
    """Order of parts by id and offset, those without an id last."""
    return (True, owner[2]) if owner[1] is None else (False, owner[1], owner[2])


def _chunks(batches: Iterator[pa.RecordBatch], hasher: Hasher) -> Iterator[tuple[Chunk, list[Owner]]]:
    """Chunks of whole pieces, with language, id and offset of each of their parts, in the order of the ids."""
    held: list[tuple[Owner, bytes]] = []
    size = 0

    def made() -> tuple[Chunk, list[Owner]]:
        held.sort(key=lambda h: _by_id(h[0]))
        owners, texts = [o for o, _ in held], [t for _, t in held]
        held.clear()
        return chunk(texts, [xxhash.xxh3_64_intdigest(o[0]) for o in owners], hasher), owners

    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(begin, SLICE_ROWS)
            for lang, doc, text in zip(part.column("lang").to_pylist(), part.column("doc_id").to_pylist(), strings(part, "text")):
                for offset, piece in _parts(text.encode()):
                    held.append(((lang, doc, offset), piece))
                    size += len(piece) + 1
                    if size >= CHUNK_BYTES:
                        yield made()
                        size = 0
    if held:
        yield made()


Choose = Callable[[Chunk], list[np.ndarray]]


def _made_of(found: Chunk, n: int, at: np.ndarray) -> np.ndarray:
    """Three columns: the fingerprint of the ``n`` words from each place on, and those of their first and of their last
    ``n - 1`` words; of single words a second hash and their language."""
    if n == 1:
        return np.column_stack([found.fingerprints(1, at), found.others(at), found.seed[at]])
    return np.column_stack([found.fingerprints(n, at), found.fingerprints(n - 1, at), found.fingerprints(n - 1, at + 1)])


def _tallied(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and how often each is there. Those of one fingerprint with unlike parts stay apart."""
    _, first, back, counts = np.unique(rows[:, 0], return_index=True, return_inverse=True, return_counts=True)
    odd = np.flatnonzero((rows != rows[first][back]).any(axis=1))
    np.subtract.at(counts, back[odd], 1)
    return np.concatenate([rows[first], rows[odd]]), np.concatenate([counts, np.ones(len(odd), np.int64)])


def _count(rows: DataFrame, make: Callable[[], Choose]) -> DataFrame:
    """``fp, left, right, words, n``: the n-grams at the places that ``make()`` takes from each chunk, by their
    fingerprints and those of their parts, counted in each task and then by a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        choose, hasher = make(), Hasher()
        held: dict[int, list[np.ndarray]] = {}

        def drained() -> Iterator[pa.RecordBatch]:
            for n, parts in held.items():
                rows, counts = _tallied(np.concatenate(parts))
                for begin in range(0, len(rows), SENT_ROWS):
                    part = rows[begin : begin + SENT_ROWS]
                    columns = [*(pa.array(np.ascontiguousarray(part[:, k]).view(np.int64)) for k in range(3)), pa.array(np.full(len(part), n, np.int32)), pa.array(counts[begin : begin + SENT_ROWS], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["fp", "left", "right", "words", "n"])
            held.clear()

        for found, _ in _chunks(batches, hasher):
            for n, at in enumerate(choose(found), start=1):
                if len(at):
                    held.setdefault(n, []).append(_made_of(found, n, at))
            if sum(len(r) for parts in held.values() for r in parts) >= HELD_FINGERPRINTS:
                yield from drained()
        yield from drained()

    return rows.mapInArrow(run, "fp bigint, left bigint, right bigint, words int, n bigint").groupBy("fp", "left", "right", "words").agg(F.sum("n").alias("n"))


def _same_word(found: Chunk, at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether the words at ``at`` and ``first`` have the same bytes."""
    length = found.stop - found.start
    same = length[at] == length[first]
    for size in np.unique(length[at[same]]):
        rows = np.flatnonzero(same & (length[at] == size))
        step = max(1, (1 << 22) // int(size))
        for k in range(0, len(rows), step):
            one = rows[k : k + step]
            span = np.arange(size)
            same[one] = (found.raw[found.start[at[one]][:, None] + span] == found.raw[found.start[first[one]][:, None] + span]).all(axis=1)
    return same


@dataclass
class Groups:
    """Distinct phrases: a fingerprint, the numbers of its words (-1 beyond its end) and behind them that of its
    language, its occurrences, and where it first stands as the number of an owner and a byte offset."""

    fp: np.ndarray
    ids: np.ndarray
    count: np.ndarray
    owner: np.ndarray
    at: np.ndarray

    @staticmethod
    def joined(parts: list[Groups]) -> Groups:
        return Groups(*(np.concatenate([getattr(p, n) for p in parts]) for n in ("fp", "ids", "count", "owner", "at")))

    def merged(self, rank: np.ndarray) -> Groups:
        """One row per phrase, with the first owner by ``rank``. Rows of one fingerprint with other words get a
        fingerprint of their own."""
        if not len(self.fp):
            return self
        fp, salt = self.fp, np.uint64(1)
        while True:
            order = np.argsort(fp, kind="stable")
            sorted_fp = fp[order]
            start = np.flatnonzero(np.concatenate([[True], sorted_fp[1:] != sorted_fp[:-1]]))
            head = np.repeat(order[start], np.diff(np.append(start, len(order))))
            odd = order[(self.ids[order] != self.ids[head]).any(axis=1)]
            if not len(odd):
                break
            fp = fp.copy()
            for k in range(self.ids.shape[1]):
                fp[odd] = _mixed(fp[odd] ^ (self.ids[odd, k].astype(np.int64).view(np.uint64) + salt))
            salt += np.uint64(1)
        first = np.minimum.reduceat((rank[self.owner[order]] << 40) | self.at[order], start)
        back = np.argsort(rank)
        return Groups(sorted_fp[start], self.ids[order[start]], np.add.reduceat(self.count[order], start), back[first >> 40].astype(np.int32), first & ((1 << 40) - 1))


def grouped(found: Chunk, chosen: list[np.ndarray], known: dict[bytes | int, int], first_owner: int = 0, offsets: np.ndarray | None = None) -> Groups:
    """The chosen places, ``chosen[n - 1]`` for ``n`` words, as groups. Words get their numbers in ``known`` by their
    bytes: those with one hash are compared byte by byte with the first of them. Languages have numbers there too."""
    number = np.full(len(found.word), -1, np.int32)
    seeds, of = np.unique(found.seed, return_inverse=True)
    lang = np.array([known.setdefault(k, len(known)) for k in seeds.tolist()], np.int32)[of]
    used = np.zeros(len(found.word) + len(chosen), bool)
    for n, at in enumerate(chosen, start=1):
        for k in range(n):
            used[at + k] = True
    at = np.flatnonzero(used)
    if len(at):
        _, first, back = np.unique(found.word[at], return_index=True, return_inverse=True)
        same = _same_word(found, at, at[first][back])
        number[at] = np.array([known.setdefault(found.phrase(k, 1), len(known)) for k in at[first].tolist()])[back]
        for k in at[~same].tolist():
            number[k] = known.setdefault(found.phrase(k, 1), len(known))
    parts = []
    for n, at in enumerate(chosen, start=1):
        ids = np.full((len(at), len(chosen) + 1), -1, np.int32)
        ids[:, -1] = lang[at]
        for k in range(n):
            ids[:, k] = number[at + k]
        doc = found.doc[at]
        place = found.start[at] - found.begin[doc] + (0 if offsets is None else offsets[doc])
        parts.append(Groups(found.fingerprints(n, at), ids, np.ones(len(at), np.int64), (first_owner + doc).astype(np.int32), place))
    return Groups.joined(parts)


def _places(found: Chunk, tables: list[np.ndarray], known: int, upto: int) -> list[np.ndarray]:
    """Per length up to ``upto`` the places of phrases all of whose parts of up to ``known`` words pass the filters
    (as does the phrase itself up to that length)."""
    out = []
    for n in range(1, upto + 1):
        if n == 1:
            at = np.arange(len(found.word))
        else:
            before = np.zeros(len(found.word) + 1, bool)
            before[out[-1]] = True
            at = out[-1][before[out[-1] + 1]]
            if n == 2:
                at = at[found.within(2)[at]]
        out.append(at[bit_filter.passing(found.fingerprints(n, at), tables)] if n <= known else at)
    return out


def _materialised(rows: DataFrame, make: Callable[[], Choose], id_type: str) -> DataFrame:
    """``fp, lang, phrase, words, n, doc_id, at``: the chosen phrases as text, counted in each task, with their first
    occurrence by id and byte offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        choose, hasher, id_type_here = make(), Hasher(), pa.null()
        known: dict[bytes | int, int] = {}
        owners: list[Owner] = []
        held: list[Groups] = []

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal id_type_here
            for batch in batches:
                id_type_here = batch.column("doc_id").type
                yield batch

        def merged() -> Groups:
            rank = np.empty(len(owners), np.int64)
            rank[sorted(range(len(owners)), key=lambda k: _by_id(owners[k]))] = np.arange(len(owners))
            return Groups.joined(held).merged(rank)

        def drained(groups: Groups) -> Iterator[pa.RecordBatch]:
            words = list(known)
            for begin in range(0, len(groups.fp), SENT_ROWS):
                end = begin + SENT_ROWS
                ids = groups.ids[begin:end, :-1]
                phrases = [b" ".join([words[w] for w in row if w >= 0]) for row in ids.tolist()]
                places = [owners[k] for k in groups.owner[begin:end].tolist()]
                columns = [
                    pa.array(groups.fp[begin:end].view(np.int64)), pa.array([o[0] for o in places], pa.string()), pa.array(phrases, pa.string()), pa.array((ids >= 0).sum(axis=1).astype(np.int32)),
                    pa.array(groups.count[begin:end]), pa.array([o[1] for o in places], id_type_here), pa.array(groups.at[begin:end]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["fp", "lang", "phrase", "words", "n", "doc_id", "at"])
            for one in (known, owners, held):
                one.clear()

        for found, parts in _chunks(typed(), hasher):
            one = grouped(found, choose(found), known, len(owners), np.array([o[2] for o in parts]))
            owners += parts
            # Parts of a chunk are in the order of their ids.
            held.append(one.merged(np.arange(len(owners))))
            if sum(len(g.fp) for g in held) >= HELD_PHRASES:
                held[:] = [merged()]
                if len(held[0].fp) >= HELD_PHRASES // 2:
                    yield from drained(held[0])
        if held:
            yield from drained(merged())

    return rows.mapInArrow(run, f"fp bigint, lang string, phrase string, words int, n bigint, doc_id {id_type}, at bigint")


class Sent:
    """Filters that were sent to the tasks; they are given back at the end."""

    def __init__(self, spark) -> None:
        self.context, self.filters = spark.sparkContext, []

    def add(self, fingerprints: DataFrame) -> None:
        self.filters.append(self.context.broadcast(bit_filter.build(fingerprints, "fp", FILTER_BITS)))

    def clear(self) -> None:
        for one in self.filters:
            one.unpersist()
        self.filters.clear()

    def places(self, known: int, upto: int, least: int = 1) -> Callable[[], Choose]:
        """Places as of :func:`_places`, those of ``least`` words or more."""
        filters = list(self.filters)

        def make() -> Choose:
            tables = [f.value for f in filters]
            return lambda found: [at if n >= least else at[:0] for n, at in enumerate(_places(found, tables, known, upto), start=1)]

        return make

    def passing(self, upto: int) -> Callable[[], Choose]:
        """Places of all phrases that pass the filters, whether their parts do or not."""
        filters = list(self.filters)

        def make() -> Choose:
            tables = [f.value for f in filters]

            def one(found: Chunk) -> list[np.ndarray]:
                every = [np.flatnonzero(found.within(n)) for n in range(1, upto + 1)]
                return [at[bit_filter.passing(found.fingerprints(n, at), tables)] for n, at in enumerate(every, start=1)]

            return one

        return make


def _rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(col(id_col).alias("doc_id"), F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"), col(text_col).cast("string").alias("text"))


def counted(rows: DataFrame, max_words: int, min_count: int, sent: Sent) -> list[DataFrame]:
    """``fp, left, right, words, n`` of all n-grams with ``min_count`` occurrences or more in a language, stored.

    An n-gram is as frequent as asked only if its parts are: words first, then pairs of frequent words, then what
    consists of frequent pairs, each behind a filter of the fingerprints found so far (which are left in ``sent``).
    """
    out = []
    for known, least, upto in ((0, 1, 1), (1, 2, min(2, max_words)), (2, 3, max_words)):
        if least > upto:
            break
        out.append(cut(_count(rows, sent.places(known, upto, least)).where(F.col("n") >= min_count)))
        sent.add(out[-1])
    return out


def _as_text(rows: DataFrame, make: Callable[[], Choose], id_type: str) -> DataFrame:
    """``lang, phrase, words, a, fp, doc_id, at``: the groups are the words themselves, so that phrases with one fingerprint
    stay apart."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at")
    found = _materialised(rows, make, id_type).groupBy("lang", "phrase", "words").agg(F.sum("n").alias("a"), F.min("fp").alias("fp"), F.min(place).alias("place"))
    return found.select("lang", "phrase", "words", "a", "fp", "place.doc_id", "place.at")


def frequent(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, phrase, words, a, doc_id, at`` for all phrases of one to ``max_words`` words with ``min_count``
    occurrences or more in a language, stored; ``doc_id`` and ``at`` (bytes) point to the first occurrence."""
    rows, sent = _rows(docs, id_col, text_col, lang_col), Sent(docs.sparkSession)
    counted(rows, max_words, min_count, sent)
    texts = _as_text(rows, sent.places(max_words, max_words), docs.schema[id_col].dataType.simpleString())
    stored = cut(texts.where(F.col("a") >= min_count).drop("fp"))
    sent.clear()
    return stored


def word_totals(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, n``: all words of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, int] = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(begin, SLICE_ROWS)
                for lang, text in zip(part.column("lang").to_pylist(), strings(part, "text")):
                    blank = np.frombuffer(b" " + text.encode().translate(_TRANSLATE), np.uint8)
                    gap = (blank == 32) | (blank == 10)
                    words[lang] = words.get(lang, 0) + int(np.count_nonzero(gap[:-1] & ~gap[1:]))
        yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["lang", "n"])

    rows = docs.select(F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "lang string, n bigint").groupBy("lang").agg(F.sum("n").alias("n"))


def scored(counts: DataFrame) -> DataFrame:
    """The phrases of two words or more with ``l``, ``r`` and ``score`` of their weakest cut."""
    parts = F.split("phrase", " ")
    rows = counts.where("words >= 2").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    rows = rows.withColumns({"left": F.array_join(F.slice(parts, F.lit(1), F.col("cut")), " "), "right": F.array_join(F.slice(parts, F.col("cut") + 1, F.col("words") - F.col("cut")), " ")})
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    none = F.lit(0).cast("long")
    rows = rows.withColumns({"salt_l": F.when(F.col("cut") == 1, salt).otherwise(none), "salt_r": F.when(F.col("words") - F.col("cut") == 1, salt).otherwise(none)})
    salts = F.explode(F.when(F.col("words") == 1, F.sequence(none, F.lit(SALTS - 1).cast("long"))).otherwise(F.array(none)))
    spread = counts.select("lang", "phrase", "a", salts.alias("salt"))
    left = spread.select("lang", F.col("phrase").alias("left"), F.col("salt").alias("salt_l"), F.col("a").alias("l"))
    right = spread.select("lang", F.col("phrase").alias("right"), F.col("salt").alias("salt_r"), F.col("a").alias("r"))
    both = rows.join(left, ["lang", "left", "salt_l"]).join(right, ["lang", "right", "salt_r"])
    weakest = F.min(F.struct(_score(F.col("a"), F.col("l") + F.col("r")).alias("score"), "cut", "l", "r")).alias("weakest")
    rest = [n for n in counts.columns if n not in ("lang", "phrase")]
    return both.groupBy("lang", "phrase", *rest).agg(weakest).select("lang", "phrase", *rest, "weakest.l", "weakest.r", "weakest.score")


def _weighed(levels: list[DataFrame], max_words: int) -> list[DataFrame]:
    """Per length from two words on: ``fp, seed, a``, the counts (``heads``, ``tails``) and fingerprints (``head_fps``,
    ``tail_fps``) of all first and last parts, itself included, and ``inner``, the phrases inside."""
    every = reduce(DataFrame.unionByName, levels)
    one = F.array("n")
    start = every.where("words = 1").select("fp", F.col("right").alias("seed"), F.col("n").alias("a"), one.alias("heads"), one.alias("tails"), F.array("fp").alias("head_fps"), F.array("fp").alias("tail_fps"), F.array().cast("array<bigint>").alias("inner"))
    # One word begins or ends many pairs: pairs are dealt to salts, and each salt has all words.
    shorter = start.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = []
    for n in range(2, max_words + 1):
        salt = F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int") if n == 2 else F.lit(0)
        rows = every.where(F.col("words") == n).select("fp", "left", "right", F.col("n").alias("a"), salt.alias("salt"))
        left = shorter.select(F.col("fp").alias("left"), "salt", "seed", "heads", "head_fps", F.col("inner").alias("left_inner"))
        right = shorter.select(F.col("fp").alias("right"), "salt", "tails", "tail_fps", F.col("inner").alias("right_inner"))
        inner = F.array_union(F.array_union("left_inner", "right_inner"), F.array("left", "right")) if n > 2 else F.array().cast("array<bigint>")
        made = rows.join(left, ["left", "salt"]).join(right, ["right", "salt"]).select(
            "fp", "seed", "a", F.array_append("heads", F.col("a")).alias("heads"), F.array_append("tails", F.col("a")).alias("tails"),
            F.array_append("head_fps", F.col("fp")).alias("head_fps"), F.array_append("tail_fps", F.col("fp")).alias("tail_fps"), inner.alias("inner"),
        )
        out.append(cut(made))
        shorter = out[-1].withColumn("salt", F.lit(0))
    return out


def _leading(weighed: list[DataFrame], top: int, inside_percent: int) -> DataFrame:
    """The candidates that may be among the first ``top`` of their language, ties at the end included."""
    rows = reduce(DataFrame.unionByName, weighed)
    # ``heads[k]`` counts the first ``k + 1`` words.
    cuts = F.transform(F.sequence(F.lit(1), F.size("heads") - 1), lambda k: F.struct(_score(F.col("a"), F.get("heads", k - 1) + F.get("tails", F.size("heads") - k - 1)).alias("score"), k.alias("cut")))
    rated = rows.withColumn("weakest", F.array_min(cuts))
    around = rows.select(F.explode("inner").alias("fp"), "a").groupBy("fp").agg(F.max("a").alias("around"))
    kept = rated.join(around, "fp", "left").where(F.col("around").isNull() | (100 * F.col("around") < inside_percent * F.col("a")))
    order = Window.partitionBy("seed").orderBy(F.desc("weakest.score"), F.desc("a"))
    ranked = kept.withColumn("place", F.rank().over(order)).where(F.col("place") <= top)
    k, n = F.col("weakest.cut"), F.size("heads")
    return ranked.select("fp", "a", F.get("heads", k - 1).alias("l"), F.get("tails", n - k - 1).alias("r"), F.col("weakest.score").alias("score"), "heads", "tails", "head_fps", "tail_fps")


def _score(a: Column, parts: Column) -> Column:
    """``SCALE * a`` by the counts of both parts, rounded down; the product may pass 64 bits."""
    return F.call_function("div", a.cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(8,0)"), parts.cast("decimal(20,0)"))


def _from_texts(docs: DataFrame, top: int, max_words: int, min_count: int, inside_percent: int, *columns: str) -> DataFrame:
    """The ranked candidates with every frequent phrase taken as text: the way where fingerprints have collided."""
    counts = frequent(docs, max_words, min_count, *columns)
    pairs = scored(counts)
    inner = [F.struct(F.lit(k).alias("from"), F.lit(n).alias("size"), F.lit(m).alias("of")) for m in range(3, max_words + 1) for n in range(2, m) for k in range(1, m - n + 2)]
    if inner:
        longer = counts.where("words >= 3").select("lang", "a", "words", F.split("phrase", " ").alias("parts"), F.explode(F.array(*inner)).alias("s")).where("s.of = words")
        around = longer.groupBy("lang", F.array_join(F.slice("parts", F.col("s.from"), F.col("s.size")), " ").alias("phrase")).agg(F.max("a").alias("around"))
        pairs = pairs.join(around, ["lang", "phrase"], "left").where(F.col("around").isNull() | (100 * F.col("around") < inside_percent * F.col("a")))
    return pairs.select("lang", "phrase", "a", "l", "r", "score", "doc_id", "at")


def collocations(
    docs: DataFrame, top: int = TOP, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, inside_percent: int = INSIDE_PERCENT,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score, doc_id, at``: the phrases of two to ``max_words`` words that stick
    together most, the first ``top`` of each language.

    Every pass reads whole texts. n-grams are hashed from prefix polynomials, numpy counts them in a task by their
    fingerprint and those of their parts, a shuffle adds the counts up; the next pass only looks at what consists
    of frequent parts (behind a bit filter of bounded size). Candidates are scored by these counts. A last pass takes
    those that may be among the first, and their parts, as text, with pointers to where they first stand: the words
    of one fingerprint are compared byte by byte in the task, and the shuffle groups by the text. If any count
    differs from that of its fingerprint, or two frequent n-grams share one, all frequent phrases are taken as text
    and the candidates scored again from these.

    NULL texts are empty, a NULL language is ``und``; repeated rows count as often as they are there; a text without
    words gives nothing; ids may be NULL or repeated; an empty table has no phrases; further columns are ignored.
    """
    rows, sent = _rows(docs, id_col, text_col, lang_col), Sent(docs.sparkSession)
    levels = counted(rows, max_words, min_count, sent)
    sent.clear()
    prints = reduce(DataFrame.unionByName, levels).select("fp")
    weighed = _weighed(levels, max_words)
    leading = cut(_leading(weighed, top, inside_percent))
    expected = leading.select(F.inline(F.arrays_zip(F.concat("head_fps", "tail_fps").alias("fp"), F.concat("heads", "tails").alias("a")))).distinct()
    expected = cut(expected)
    sent.add(expected)
    texts = cut(_as_text(rows, sent.passing(max_words), docs.schema[id_col].dataType.simpleString()))
    sent.clear()
    shared = prints.groupBy("fp").count().where("count > 1")
    differing = expected.join(texts.groupBy("fp").agg(F.sum("a").alias("in_text"), F.count(F.lit(1)).alias("phrases")), "fp", "left").where(~(F.col("in_text").eqNullSafe(F.col("a")) & (F.col("phrases") == 1)))
    if differing.isEmpty() and shared.isEmpty():
        pairs = leading.select("fp", "l", "r", "score").join(texts, "fp").select("lang", "phrase", "a", "l", "r", "score", "doc_id", "at")
    else:
        pairs = _from_texts(docs, top, max_words, min_count, inside_percent, id_col, text_col, lang_col)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    whole = ranked.join(broadcast_if_small(word_totals(docs, text_col, lang_col)), "lang")
    return whole.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "doc_id", "at")


SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
),
p AS (SELECT lang, row_number() OVER () AS piece, ws FROM (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM d)),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM p GROUP BY lang),
w AS (SELECT lang, piece, unnest(ws) AS a, generate_subscripts(ws, 1) AS pos FROM p),
u AS (SELECT lang, a, lead(a, 1) OVER v AS b, lead(a, 2) OVER v AS c, lead(a, 3) OVER v AS d FROM w WINDOW v AS (PARTITION BY piece ORDER BY pos)),
g AS (
  SELECT lang, 1 AS k, a AS phrase FROM u UNION ALL SELECT lang, 2, a || ' ' || b FROM u WHERE b IS NOT NULL
  UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c FROM u WHERE c IS NOT NULL UNION ALL SELECT lang, 4, a || ' ' || b || ' ' || c || ' ' || d FROM u WHERE d IS NOT NULL
),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
e AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
x AS (SELECT e.*, c FROM e, (VALUES (1), (2), (3)) AS s(c) WHERE c < k),
y AS (
  SELECT x.lang, x.phrase, x.a, x.c, l.a AS l, r.a AS r, (2000000::HUGEINT * x.a // (l.a + r.a))::BIGINT AS score
  FROM x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(ws[1:c], ' ')
    JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(ws[c + 1:x.k], ' ')
),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
i AS (
  SELECT lang, array_to_string(ws[s:s + m - 1], ' ') AS phrase, max(a) AS around
  FROM e, (VALUES (1), (2), (3)) AS q(s), (VALUES (2), (3)) AS v(m) WHERE m < k AND s + m - 1 <= k GROUP BY ALL
)
SELECT z.lang, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, z.phrase)::BIGINT AS rank, z.phrase, a, l, r, n, score
FROM z JOIN t ON t.lang = z.lang LEFT JOIN i ON i.lang = z.lang AND i.phrase = z.phrase
WHERE around IS NULL OR 100 * around < 80 * a
QUALIFY rank <= 2000
"""
