"""How far the sources of a language lie apart in the words they use."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.llm.common import SLICE_ROWS, strings
from newsmill.session import broadcast_if_small, cut

# A term counts in a language from so many of its documents on; shares are parts of so many.
MIN_DOCS = 10
UNIT = 1_000_000_000
# Terms that are reported per source.
TERM_RANKS = 10
# Distinct (language, source, term) that a task holds before it sends them on.
HELD_TERMS = 300_000
# Terms and sources of one tile of the comparison.
TILE_TERMS, TILE_SOURCES = 4_096, 128

# One table lowers A-Z and blanks what is neither an ASCII letter nor part of another character.
_TRANSLATE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str) -> list[bytes]:
    """Runs of ASCII letters and of characters beyond ASCII, A-Z lower-cased."""
    return text.encode().translate(_TRANSLATE).split()


def _counted(rows: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of each term, and one row with a NULL term
    per language and source; a pair may come several times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurrences: dict[tuple[str, str], Counter] = {}
        documents: dict[tuple[str, str], Counter] = {}

        def drained() -> pa.RecordBatch:
            words = [w for found in occurrences.values() for w in (None, *found)]
            n = [c for found in occurrences.values() for c in (0, *found.values())]
            docs = [c for group, found in occurrences.items() for c in (0, *map(documents[group].__getitem__, found))]
            group = pa.array(np.repeat(np.arange(len(occurrences)), [len(found) + 1 for found in occurrences.values()]), pa.int64())
            langs, sources = (pa.array([g[k] for g in occurrences], pa.string()).take(group) for k in (0, 1))
            columns = [langs, sources, pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())]
            occurrences.clear()
            documents.clear()
            return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                for lang, source, text in zip(strings(part, "lang"), strings(part, "source"), strings(part, "text")):
                    found = terms(text)
                    group = lang, source
                    # Lists and sets are counted in C, a mapping is added key by key.
                    occurrences.setdefault(group, Counter()).update(found)
                    documents.setdefault(group, Counter()).update(set(found))
                if sum(map(len, occurrences.values())) >= HELD_TERMS:
                    yield drained()
        yield drained()

    return rows.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def _share(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(UNIT * (count + 2) / (total + 2 * kept))``; the product may pass 64 bits."""
    return F.expr("1L") + F.call_function("div", (count + 2).cast("decimal(28,0)") * F.lit(UNIT).cast("decimal(10,0)"), (total + 2 * kept).cast("decimal(20,0)"))


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """Counts of the kept terms (``lang, source, term, n, lang_n``), and for every language and source
    ``kept`` (terms of the language), ``total`` and ``lang_total`` (their occurrences)."""
    rows = docs.select(col(text_col).cast("string").alias("text"), col(lang_col).cast("string").alias("lang"), col(source_col).cast("string").alias("source"))
    counts = _counted(rows).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # A term's group has a row per source, so that the window holds few rows.
    by_term = Window.partitionBy("lang", "term")
    marked = counts.withColumns({"lang_n": F.sum("n").over(by_term), "lang_docs": F.sum("docs").over(by_term), "first": (F.row_number().over(by_term.orderBy("source")) == 1).cast("int")})
    stored = cut(marked.where(F.col("term").isNull() | (F.col("lang_docs") >= min_docs)).drop("docs", "lang_docs"))
    groups = stored.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("term").isNotNull(), F.col("first"))).alias("firsts"))
    # One row per language and source from here on.
    by_lang = Window.partitionBy("lang")
    sizes = groups.select("lang", "source", "total", F.coalesce(F.sum("firsts").over(by_lang), F.lit(0)).alias("kept"), F.sum("total").over(by_lang).alias("lang_total"))
    return stored.where("term IS NOT NULL").drop("first"), broadcast_if_small(sizes)


def _tiles(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, source, other, present, value``: sums of the gaps over terms that a tile of sources or the
    other one has, and how many terms these are; several rows per pair of sources."""
    numbered = sizes.withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    sides = numbered.select(
        "lang", "source", "total", "kept", F.expr(f"number div {TILE_SOURCES}").alias("tile"), (F.col("number") % TILE_SOURCES).alias("at"),
        F.expr(f"max(number) OVER (PARTITION BY lang) div {TILE_SOURCES}").alias("last"), F.ceil(F.col("kept") / TILE_TERMS).alias("blocks"),
    ).where("kept > 0")
    share = _share(F.col("n"), F.col("total"), F.col("kept")).alias("p")
    place = F.pmod(F.xxhash64(F.lit(3), "term"), F.col("blocks")).alias("block")
    held = counts.join(sides, ["lang", "source"]).select("lang", "tile", "last", "at", place, "term", share, F.lit(None).cast("string").alias("source"))
    # Each block also gets the share of a term without occurrences, once per source, with the source's name.
    absent = _share(F.lit(0), F.col("total"), F.col("kept")).alias("p")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    named = sides.select("lang", "tile", "last", "at", every, F.lit(None).cast("string").alias("term"), absent, "source")
    # The tile of a row meets every tile of its language, once with each.
    spread = held.unionByName(named).withColumn("mate", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
    keyed = spread.select("lang", "block", F.least("tile", "mate").alias("a"), F.greatest("tile", "mate").alias("b"), "tile", "at", "source", "term", "p")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lang, _, a, b = key
        seen = rows[rows["term"].notna()]
        column, known = pd.factorize(seen["term"])
        labels, matrices = [], []
        for tile in (a, b):
            side = rows[rows["term"].isna() & (rows["tile"] == tile)].sort_values("at")
            labels.append(side["source"].tolist())
            matrix = np.repeat(side["p"].to_numpy(np.int64)[:, None], len(known), axis=1)
            own = (seen["tile"] == tile).to_numpy()
            matrix[seen["at"].to_numpy()[own], column[own]] = seen["p"].to_numpy()[own]
            matrices.append(matrix)
        out = []
        for name, p in zip(labels[0], matrices[0]):
            sums = (np.square(p - matrices[1]) // (p + matrices[1])).sum(axis=1)
            pairs = [(name, other, int(s)) for other, s in zip(labels[1], sums) if other != name]
            out += pairs if a == b else pairs + [(other, one, gap) for one, other, gap in pairs]
        frame = pd.DataFrame(out, columns=["source", "other", "value"]).astype({"value": "int64"})
        return frame.assign(lang=lang, present=len(known))

    return keyed.groupBy("lang", "block", "a", "b").applyInPandas(compare, "lang string, source string, other string, present bigint, value bigint")


def pair_gaps(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every other source of a language. Terms that neither tile of a pair has
    differ by the same amount each, so only their number is needed."""
    sums = _tiles(counts, sizes).groupBy("lang", "source", "other").agg(F.sum("present").alias("present"), F.sum("value").alias("value"))
    sides = sizes.select("lang", "source", "kept", F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.col("kept"))).alias("p"))
    others = sides.select("lang", F.col("source").alias("other"), F.col("p").alias("q"))
    # All pairs of sources of a language are the result itself.
    pairs = sides.join(others, "lang").where("source <> other").join(sums, ["lang", "source", "other"], "left")
    rest = (F.col("kept") - F.coalesce("present", F.lit(0))) * _gap(F.col("p"), F.col("q"))
    value = F.when(F.col("kept") > 0, F.coalesce("value", F.lit(0)) + rest).otherwise(0).cast("long")
    return pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), value.alias("value"))


def term_gaps(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every kept term that a source uses more than its language does."""
    rows = counts.join(sizes, ["lang", "source"])
    both = rows.select("lang", "source", "term", _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"))
    return both.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, term_ranks: int = TERM_RANKS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: the divergence of each source from every other one of its
    language (part ``pair``), and the terms by which it departs most from its language (part ``term``).

    Each task counts whole documents and sends a row per language, source and term; nothing is gathered
    but the matrix of a tile, 4,096 terms by 128 sources. Shares are whole numbers, so every value is exact.

    NULL text, language and source are empty texts: they form a language or a source of their own. Repeated
    rows count as often as they are there. A source without kept terms has pairs, but no terms; a language
    with one source has no pairs; an empty table gives no rows. Further columns are ignored.
    """
    counts, sizes = kept_terms(docs, min_docs, text_col, lang_col, source_col)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    rank = F.row_number().over(order).alias("rank")
    pairs = pair_gaps(counts, sizes).select("*", rank)
    top = term_gaps(counts, sizes).select("*", rank).where(F.col("rank") <= term_ranks)
    return pairs.unionByName(top)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT row_id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY ALL HAVING count(DISTINCT row_id) >= 10),
v AS (SELECT lang, count(*)::HUGEINT AS kept, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
m AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (m.total + 2 * v.kept) AS p,
    1 + 1000000000::HUGEINT * (k.n + 2) // (v.total + 2 * v.kept) AS q
  FROM g JOIN m USING (lang, source) JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r
QUALIFY part = 'pair' OR rank <= 10
"""
