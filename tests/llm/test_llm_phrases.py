"""Phrase collocations against plain Python and SQL; fingerprints that collide; chunks and parts."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsmill.llm import phrases
from tests.compare import connect, difference


def pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in (re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)) if w]


def counted(texts, upto=4):
    return Counter(" ".join(w[k : k + n]) for t in texts for w in pieces(t) for n in range(1, upto + 1) for k in range(len(w) - n + 1))


def brute(rows, min_count, top):
    out = []
    for lang in {r[2] or "und" for r in rows}:
        texts = [t for _, t, x, *_ in rows if (x or "und") == lang]
        f = {p: c for p, c in counted(texts).items() if c >= min_count}
        found = []
        for p, a in f.items():
            words = p.split(" ")
            cuts = [(2_000_000 * a // (f[" ".join(words[:k])] + f[" ".join(words[k:])]), k) for k in range(1, len(words))]
            inside = any(100 * c >= 80 * a for q, c in f.items() if f" {p} " in f" {q} " and q.count(" ") > p.count(" "))
            if cuts and not inside:
                score, k = min(cuts)
                found.append((-score, -a, p.encode(), p, a, f[" ".join(words[:k])], f[" ".join(words[k:])]))
        n = sum(len(w) for t in texts for w in pieces(t))
        out += [(lang, r + 1, p, a, x, y, n, -score) for r, (score, _, _, p, a, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


ROWS = [
    (k, text, lang, "clash", 5)
    for k, (text, lang) in enumerate(
        [("New York City is big, new york is. NEW YORK city", "en")] * 4 + [("a b a b a b a b\ta\x0bb a; été à la mer", None)] * 3 + [("été à la Mer!  été à", "fr")] * 3
        + [(None, "en"), ("", "en"), (" \n.,", "fr"), ("x" * 70_000 + " y", "en"), ("x" * 70_000 + " y", "en"), ("z\x00z q q " * 3000, "de")]
    )
]
SCHEMA = "doc_id long, text string, lang string, phrase string, n int"


@pytest.mark.parametrize("top", [3, 2000])
def test_as_in_plain_python(spark, top):
    rows = ROWS + ROWS[:2]
    got = phrases.collocations(spark.createDataFrame(rows, SCHEMA), top=top, min_count=2)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "doc_id", "at"]
    assert sorted(tuple(r)[:8] for r in got.collect()) == brute(rows, 2, top)


def test_pointers_lead_to_the_first_occurrence(spark):
    got = phrases.frequent(spark.createDataFrame([(None, "q r q r", None, "", 0), *ROWS[::-1]], SCHEMA), min_count=2).collect()
    texts = {k: t for k, t, *_ in ROWS}
    assert len(got) > 50
    for r in got:
        if r.phrase in ("q", "r", "q r"):
            assert (r.doc_id, r["at"]) == (None, {"q": 0, "r": 2, "q r": 0}[r.phrase])
            continue
        assert r.doc_id == min(k for k, t, lang, *_ in ROWS if (lang or "und") == r.lang and counted([t])[r.phrase])
        raw = texts[r.doc_id].encode().lower()
        there = raw[r["at"] :].decode()
        assert re.match(r"[ \t]+".join(map(re.escape, r.phrase.split(" "))) + r"(?![^\x20\x09.,;:!?\x0A-\x0D])", there)


def test_shared_fingerprints_are_settled_by_the_texts(spark, monkeypatch):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    want = sorted(map(tuple, phrases.collocations(rows, min_count=2).collect()))
    calls = []
    keep, count = phrases._from_texts, phrases.counted
    monkeypatch.setattr(phrases, "_from_texts", lambda *a: calls.append(1) or keep(*a))
    assert sorted(map(tuple, phrases.collocations(rows, min_count=2).collect())) == want and not calls
    # One count is off, as if another n-gram had the fingerprint too.
    off = F.when((F.col("words") == 2) & (F.col("n") == 8), F.col("n") + 1).otherwise(F.col("n"))
    monkeypatch.setattr(phrases, "counted", lambda *a: [level.withColumn("n", off) for level in count(*a)])
    assert sorted(map(tuple, phrases.collocations(rows, min_count=2).collect())) == want and calls == [1]


def test_rows_with_one_fingerprint_and_unlike_parts_stay_apart():
    rows = np.array([[1, 2, 3], [1, 2, 3], [1, 2, 4], [5, 5, 5], [1, 2, 4]], np.uint64)
    got, counts = phrases._tallied(rows)
    total = Counter()
    for row, n in zip(got.tolist(), counts.tolist()):
        total[tuple(row)] += n
    assert total == {(1, 2, 3): 2, (1, 2, 4): 2, (5, 5, 5): 1}


def test_nothing_to_find(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    assert phrases.collocations(rows.limit(0)).count() == 0
    assert phrases.collocations(rows, min_count=10**6).count() == 0


class Colliding(phrases.Chunk):
    """Four fingerprints for everything."""

    def fingerprints(self, n, at):
        return super().fingerprints(n, at) & np.uint64(3)


def phrases_of(found, n_docs):
    known = {}
    groups = phrases.grouped(found, phrases._places(found, [], 0, 4), known).merged(np.arange(n_docs))
    texts = [b" ".join(list(known)[w] for w in row if w >= 0).decode() for row in groups.ids[:, :-1]]
    assert len(set(texts)) == len(texts)
    return Counter(dict(zip(texts, groups.count.tolist())))


words = st.lists(st.sampled_from(["a", "b", "ab", "é", "A", "long" * 9, ".", "\n", "\t", ""]), max_size=60).map(" ".join)


@settings(max_examples=60, deadline=None)
@given(st.lists(words, max_size=4), st.booleans())
def test_groups_are_phrases_whatever_the_fingerprints(texts, colliding):
    found = phrases.chunk([t.encode() for t in texts], [7] * len(texts), phrases.Hasher())
    if colliding:
        found = Colliding(**vars(found))
    assert phrases_of(found, len(texts)) == counted(texts)


@settings(max_examples=60, deadline=None)
@given(words, words)
def test_same_words_have_the_same_fingerprint_anywhere(before, text):
    hasher = phrases.Hasher()
    alone = phrases.chunk([text.encode()], [5], hasher)
    later = phrases.chunk([before.encode(), text.encode()], [9, 5], hasher)
    for n in (1, 2, 3):
        at, moved = np.flatnonzero(alone.within(n)), np.flatnonzero(later.within(n) & (later.doc == 1))
        assert (alone.fingerprints(n, at) == later.fingerprints(n, moved)).all()


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 40)
    long = "one two three. four five, six " * 9 + "w " * 60 + ". end of it"
    parts = list(phrases._parts(long.encode()))
    assert b"".join(p for _, p in parts) == long.encode() and len(parts) > 3
    assert counted(p.decode() for _, p in parts) == counted([long])
    rows = pa.RecordBatch.from_pydict({"lang": ["x"] * 3, "doc_id": [2, 1, None], "text": [long, "a b", None]})
    got = Counter()
    for found, owners in phrases._chunks(iter([rows]), phrases.Hasher()):
        assert [o[1] for o in owners] == sorted((o[1] for o in owners), key=lambda d: (d is None, d or 0))
        got += phrases_of(found, len(owners))
    assert got == counted([long, "a b"])


def test_scores_past_64_bits(spark):
    big = 6 * 10**15
    rows = [("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big - 1)]
    (got,) = phrases.scored(spark.createDataFrame(rows, "lang string, phrase string, words int, a long")).collect()
    assert (got.l, got.r, got.score) == (big, big, 2_000_000 * (big - 1) // (2 * big))


def test_query_as_its_sql(spark, folder):
    import __spark_entry__ as entry

    assert difference(entry.queries()["op12_fingerprint_collocations"](spark, folder), connect(folder), phrases.SQL) is None
