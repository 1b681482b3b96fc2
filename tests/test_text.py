import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsmill.functions import text as tx
from newsmill.functions.dates import decade, parsed


def apply(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_white_space_is_that_of_the_producer():
    assert all(c.isspace() for c in tx.WHITE)
    assert {chr(i) for i in range(0x3100) if chr(i).isspace()} == set(tx.WHITE)


def test_every_white_character_collapses(spark):
    values = [f"a{c}b" for c in tx.WHITE] + ["a\u200bb", "a\x00b"]
    found = apply(spark, values, tx.collapse)
    assert found == ["a b"] * len(tx.WHITE) + ["a\u200bb", "a\x00b"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="a é1(2026)\t\n  \x1f_-", max_size=20), min_size=20, max_size=20))
def test_text_rules_against_plain_python(spark, values):
    def title(s):
        s = re.sub(r"\(\d{4}\)", "", re.sub(r"\s+", " ", s.strip())).strip()
        return s or tx.UNTITLED

    assert apply(spark, values, tx.clean_title) == [title(v) for v in values]
    words = re.compile(r"\b(?:a|1)\b", re.I)
    assert apply(spark, values, lambda c: tx.has_any_word(c, ["a", "1"])) == [bool(words.search(v)) for v in values]
    years = [re.search(r"\b(?:19|20)\d{2}\b", v) for v in values]
    assert apply(spark, values, tx.any_year) == [m and m.group() for m in years]


def test_prefix_is_literal_and_ends_a_word(spark):
    values = ["The end", "the", "Theory", "A the", None, "theé", "a.b c", "axb c"]
    assert apply(spark, values, lambda c: tx.starts_with_word(c, "The")) == [True, True, False, False, False, False, False, False]
    assert apply(spark, values, lambda c: tx.starts_with_word(c, "a.b"))[-2:] == [True, False]


def test_ids(spark):
    values = ["5", "0", "-5", "ab", "abc", " 12 ", "", None, "1234567890123"]
    assert apply(spark, values, tx.valid_id) == [True, False, False, False, True, True, False, False, True]


def test_urls(spark):
    values = ["http://a.b", "HTTPS://x.org/p?q#f", "ftp://a.b", "http://.a", "http:// a", "http://ab c", None, " http://ab "]
    assert apply(spark, values, tx.valid_url) == [True, True, False, False, False, False, False, True]


def test_file_names(spark):
    values = ["https://h/a/b.png?x=1#f", "https://h/a/", "https://h", "https://h/pic", "http://h/a:b|c.jpg", None, "https://h/p.png;v=1"]
    assert apply(spark, values, tx.file_name_from_url) == ["b.png", "image.jpg", "image.jpg", "pic.jpg", "a_b_c.jpg", "image.jpg", "p.png"]


def test_cue_time_cuts_milliseconds(spark):
    assert apply(spark, [0.0, 3661.9999, 59.5], tx.cue_time, "double") == ["00:00:00,000", "01:01:01,999", "00:00:59,500"]


def test_labels(spark):
    values = ['[{"id": 1, "name": "News "}, {"name" : "Tech"}]', "['Politics', 'Business']", "pdf_two_column", "123", " ", None, "a,,b", "Arts & Life"]
    expected = [["News", "Tech"], ["Politics", "Business"], ["pdf", "two", "column"], ["123"], [], [], ["a", "b"], ["Arts & Life"]]
    assert apply(spark, values, tx.parse_labels) == expected


def test_numbers_in_text(spark):
    values = ["Mentions: 25", "Score 4.5/10", "-.5 x", "none", None, "a (2026) b (1999)"]
    assert apply(spark, values, tx.first_number) == ["25", "4.5", "-.5", None, None, "2026"]
    assert apply(spark, values, tx.bracketed_year)[-1] == "2026"


def test_bytes(spark):
    values = [b"\xef\xbb\xbfhi", "hé".encode("utf-16"), "hé".encode(), "hé".encode("cp1252"), b"\xef\xbb\xbfa\xff", b""]
    assert apply(spark, values, tx.decode_bytes, "binary") == ["hi", "hé", "hé", "hé", "a�", ""]


def test_other_charsets_and_cut_units(spark):
    values = ["Łódź €".encode("cp1250"), "ok".encode(), b"\xff\xfeh\x00x", None]
    assert apply(spark, values, lambda c: tx.decode_bytes(c, "cp1250"), "binary") == ["Łódź €", "ok", "h", None]


def test_search_text(spark):
    df = spark.createDataFrame([(" T ", "", "D", "c", "c"), (None, None, None, None, "g"), (None, None, None, " ", None)], "title string, overview string, description string, category string, genres string")
    from newsmill.operators.search import searchable_text

    found = [r[0] for r in df.select(searchable_text(df)).collect()]
    assert found == ["Title: T | Description: D | Category: c", "Genres: g", "Unknown news document"]


@pytest.mark.parametrize("year,label", [(1999, "1990s"), (2000, "2000s"), (None, "unknown")])
def test_decade(spark, year, label):
    assert apply(spark, [year], decade, "int") == [label]


def test_dates_are_parsed_row_by_row(spark):
    df = spark.createDataFrame([("2026-03-01",), ("01/02/2026",), ("2026-03-01T10:00:00Z",), ("soon",), (None,)], "d string")
    found = [str(r[0]) for r in df.select(parsed(df, "d", ["dd/MM/yyyy"])).collect()]
    assert found == ["2026-03-01 00:00:00", "2026-02-01 00:00:00", "2026-03-01 10:00:00", "None", "None"]


def test_character_references(spark):
    texts = ["a &amp; b", "&#38;lt;", "&amp;#65;", "&#233;&#xE9;&#X1F600;", "&nosuch; &eacute &eacute;", "&#0;&#xD800;&#1114112;", "plain", None, "&apos;&quot;&nbsp;"]
    got = [r.t for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(tx.decode_entities(F.col("t")).alias("t")).collect()]
    assert got == ["a & b", "&lt;", "&#65;", "éé😀", "&nosuch; &eacute é", "\ufffd\ufffd\ufffd", "plain", None, "'\"\xa0"]
