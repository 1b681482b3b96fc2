"""Source divergence against its SQL and against plain Python."""

import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from newsmill.llm import divergence
from tests.compare import connect, difference

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, kept boolean"


def brute(rows, min_docs):
    docs = [(t or "", lang or "", s or "") for _, t, lang, s, *_ in rows]
    found = [(lang, s, [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)]) for t, lang, s in docs]
    out = []
    for lang in {d[1] for d in docs}:
        own = [(s, w) for x, s, w in found if x == lang]
        frequency = Counter(t for _, w in own for t in set(w))
        kept = sorted(t for t, n in frequency.items() if n >= min_docs)
        by_source = defaultdict(Counter)
        for s, w in own:
            by_source[s].update(t for t in w if t in set(kept))
        whole = sum(by_source.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))
        gap = lambda p, q: (p - q) ** 2 // (p + q)
        for s in by_source:
            pairs = [(o, sum(gap(share(by_source[s], t), share(by_source[o], t)) for t in kept)) for o in by_source if o != s]
            above = [(t, gap(share(by_source[s], t), share(whole, t))) for t in kept if by_source[s][t] and share(by_source[s], t) > share(whole, t)]
            for part, items, most in (("pair", pairs, None), ("term", above, 10)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


ROWS = [
    (k, text, lang, source, "x", 7, True)
    for k, (text, lang, source) in enumerate(
        [("Ab cd-Ab éÉ 5x\x00y", "en", f"s{j % 7}") for j in range(21)]
        + [("ab [z] Zoë's 漢字 ab", "en", f"s{j % 5}") for j in range(12)]
        + [(None, "en", "only-null"), ("", None, None), ("ab", None, "s1"), ("word " * 5000, "fr", "s1"), ("ab cd", "en", None), ("q" * 100_000, "en", "s0")]
        + [(f"t{chr(97 + j % 26)} common {chr(97 + j % 9)}{chr(97 + j % 4)}", "de", f"s{j % 11}") for j in range(90)]
    )
]


@pytest.mark.parametrize("tiles", [(4096, 128), (4, 3), (16, 1)])
def test_as_in_plain_python(spark, monkeypatch, tiles):
    monkeypatch.setattr(divergence, "TILE_TERMS", tiles[0])
    monkeypatch.setattr(divergence, "TILE_SOURCES", tiles[1])
    rows = ROWS + ROWS[:3]
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA), min_docs=3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 3)


def test_few_rows_and_none(spark):
    one = spark.createDataFrame(ROWS[:1], SCHEMA)
    assert divergence.audit(one).count() == 0
    assert divergence.audit(one.limit(0)).count() == 0
    two = divergence.audit(spark.createDataFrame(ROWS[:2], SCHEMA)).collect()
    assert [(r.source, r.part, r.item, r.value, r["rank"]) for r in sorted(two)] == [("s0", "pair", "s1", 0, 1), ("s1", "pair", "s0", 0, 1)]


def test_counts_past_64_bits(spark):
    big = spark.createDataFrame([(10**12, 2 * 10**12, 5)], "n long, total long, kept long")
    n, total, kept = (big[c] for c in big.columns)
    assert big.select(divergence._share(n, total, kept)).first()[0] == 1 + 10**9 * (10**12 + 2) // (2 * 10**12 + 10)


def test_query_as_its_sql(spark, folder):
    import __spark_entry__ as entry

    assert difference(entry.queries()["op13_source_divergence"](spark, folder), connect(folder), divergence.SQL) is None


def test_texts_are_counted_word_by_word_in_c(monkeypatch):
    class Strict(Counter):
        def update(self, found=None, **more):
            assert not isinstance(found, Counter)
            super().update(found, **more)

    class Rows:
        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(divergence, "Counter", Strict)
    batch = pa.RecordBatch.from_pylist([{"text": "é a A", "lang": "en", "source": None}, {"text": "a", "lang": "en", "source": ""}, {"text": None, "lang": None, "source": "s"}])
    found = {tuple(r.values()) for out in divergence._counted(Rows())(iter([batch])) for r in out.to_pylist()}
    assert found == {("en", "", None, 0, 0), ("en", "", "é", 1, 1), ("en", "", "a", 3, 2), ("", "s", None, 0, 0)}
