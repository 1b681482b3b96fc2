"""Many phrases looked for in one pass over the texts: an automaton takes the place of a pattern per phrase."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.columns import text as as_text
from newsmill.session import cut

# Phrases, and their characters, of one automaton; more are looked for in further passes.
PHRASES, CHARACTERS = 200_000, 8_000_000
# Rows that are turned into Python values at a time.
SLICE_ROWS = 256


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def _automaton(phrases: list[str]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for number, phrase in enumerate(phrases):
        built.add_word(phrase, (number, len(phrase)))
    built.make_automaton()
    return built


def phrase_counts(df: DataFrame, phrases: DataFrame, phrase: str, key: str = "record_id", column: str = "content_text") -> DataFrame:
    """``key``, ``phrase``, ``times``: how often each text holds each phrase as whole words, lower-cased, overlaps included.

    An end of a phrase that is a letter, digit or underscore must not stand next to another one. Phrases are taken
    distinct and lower-cased, NULL and blank ones left out. One walk over a text finds all of them, so the time hardly
    depends on their number; an automaton is bounded, and more phrases than it holds are searched for block by
    block. NULL texts hold nothing; rows that repeat a key are counted together.
    """
    wanted = cut(phrases.select(F.lower(F.trim(as_text(phrases, phrase))).alias("phrase")).where("phrase <> ''").distinct())
    size = wanted.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.char_length("phrase")), F.lit(0)).alias("c")).first()
    blocks = max(1, -(-size["n"] // PHRASES), -(-size["c"] // CHARACTERS))
    rows = df.select(col(key).alias("_nm_key"), F.lower(as_text(df, column)).alias("_nm_text"))
    parts = [_block(rows, wanted.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == b), df.schema[key].dataType.simpleString()) for b in range(blocks)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.groupBy("_nm_key", "phrase").agg(F.sum("times").alias("times")).withColumnRenamed("_nm_key", key)


def _block(rows: DataFrame, wanted: DataFrame, key_type: str) -> DataFrame:
    # Bounded by PHRASES and CHARACTERS, give or take the evenness of the hash.
    phrases = sorted(r[0] for r in wanted.collect())
    sent = rows.sparkSession.sparkContext.broadcast(phrases)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, built = sent.value, None
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                at, names, times = [], [], []
                for row, text in enumerate(part.column("_nm_text").to_pylist()):
                    if not text or not known:
                        continue
                    built = built or _automaton(known)
                    found: dict[int, int] = {}
                    for end, (number, length) in built.iter(text):
                        begin = end - length + 1
                        if (begin and _word(text[begin]) and _word(text[begin - 1])) or (end + 1 < len(text) and _word(text[end]) and _word(text[end + 1])):
                            continue
                        found[number] = found.get(number, 0) + 1
                    at += [row] * len(found)
                    names += [known[n] for n in found]
                    times += found.values()
                keys = part.column("_nm_key").take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, pa.array(names, pa.string()), pa.array(times, pa.int64())], names=["_nm_key", "phrase", "times"])

    return rows.mapInArrow(find, f"_nm_key {key_type}, phrase string, times bigint")
