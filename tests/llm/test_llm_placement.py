"""Sharding, packing, dialogues, URL verdicts and WARC derivatives."""

import html
import random
import zlib
from collections import Counter
from html.entities import name2codepoint

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from newsmill.llm import catalogue, chat, packing, sharding, url_filter, warc
from newsmill.llm.tokens import Encoder
from newsmill.session import table
from tests.compare import connect, difference


@pytest.mark.parametrize("name", list(catalogue.SQL))
def test_query_against_its_sql(spark, folder, name):
    assert difference(catalogue.QUERIES[name](spark, folder), connect(folder), catalogue.SQL[name]) is None


def test_all_queries_are_registered():
    names = set(entry.queries())
    assert set(catalogue.QUERIES) | {"pipeline"} <= names
    assert {int(n[2:].split("_")[0]) for n in catalogue.QUERIES} == set(range(1, 11))


# Sharding


def brute_fill(shards, slots):
    """Every shard's whole permutation, then turns."""
    import xxhash

    names = sorted(set(shards))
    orders = []
    for n in names:
        start, step = xxhash.xxh3_64_intdigest(n, seed=1) % slots, xxhash.xxh3_64_intdigest(n, seed=2) % (slots - 1) + 1
        orders.append([(start + k * step) % slots for k in range(slots)])
    owner, turn = {}, 0
    while len(owner) < slots:
        s = turn % len(names)
        owner[next(x for x in orders[s] if x not in owner)] = s
        turn += 1
    return [owner[k] for k in range(slots)]


@pytest.mark.parametrize("count,slots", [(1, 7), (3, 101), (7, 7), (10, 211)])
def test_table_as_by_brute_force(count, slots):
    names = [f"s{k}" for k in range(count)]
    assert sharding.fill(names, slots).tolist() == brute_fill(names, slots)
    assert sharding.fill([*reversed(names), names[0]], slots).tolist() == brute_fill(names, slots)
    sizes = Counter(sharding.fill(names, slots).tolist())
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_few_slots_move_when_a_shard_goes():
    names = [f"s{k}" for k in range(20)]
    before, after = np.array(sorted(names))[sharding.fill(names)], np.array(sorted(names[:-1]))[sharding.fill(names[:-1])]
    moved = np.mean((before != after) & (before != names[-1]))
    assert moved < 0.06
    for wrong in ([], names):
        with pytest.raises(ValueError):
            sharding.fill(wrong, 18)


def test_placement(spark, tmp_path):
    rows = [(k, f"t{k}", "x") for k in range(3000)] + [(None, f"n{k}", "x") for k in range(500)] + [(5, "again", "x"), (None, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot string")
    names = [f"s{k}" for k in range(5)]
    got = sharding.place(df, names).collect()
    owner = sharding.fill(names)
    assert len(got) == len(rows) and all(r.shard == names[owner[r.slot]] for r in got)
    assert len({r.shard for r in got if r.doc_id == 5}) == 1
    assert len({r.shard for r in got if r.doc_id is None}) == 5
    assert sharding.place(df.limit(0), names).count() == 0
    sharding.write_shards(df, str(tmp_path / "out"), names, files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows) and {r.shard for r in back.select("shard").distinct().collect()} == set(names)


# Packing


def brute_place(lengths, capacity):
    """As the method says, with a list of bins and the whole sum for every choice."""
    bins, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        best = None
        for gap in sorted({g for g in bins if g >= lengths[i]}):
            counts = Counter(g for g in bins if g)
            counts[gap] -= 1
            if gap > lengths[i]:
                counts[gap - lengths[i]] += 1
            total = sum(v * v for v in counts.values())
            if best is None or total < best[0]:
                best = (total, gap)
        if best is None:
            bins.append(capacity)
            best = (0, capacity)
        at = max(k for k, g in enumerate(bins) if g == best[1]) if best[1] < capacity else len(bins) - 1
        out[i] = best[1]
        bins[at] -= lengths[i]
    return out, len(bins)


def test_places_as_by_brute_force():
    rnd = random.Random(6)
    for _ in range(60):
        capacity = rnd.choice([5, 17, 40])
        lengths = [rnd.randrange(1, capacity + 1) for _ in range(rnd.randrange(1, 60))]
        bin_of, offset = packing.place(np.array(lengths), capacity)
        gaps, count = brute_place(lengths, capacity)
        assert [capacity - o for o in offset] == [gaps[i] for i in range(len(lengths))]
        assert len(set(bin_of)) == count


def test_encoder_as_the_library():
    path = packing.vocabulary()
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    own, rnd = Encoder(path), random.Random(9)
    alphabets = ["ab 'sre\n\t  é.,123", "".join(map(chr, range(32, 0x250))) + "  \n", " 　\x85\xa0\u2009漢字😀ſİ", "<|endoftext|> \n"]
    for _ in range(1500):
        letters = rnd.choice(alphabets)
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(0, 50)))
        assert own.encode(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)
    assert own.encode("<|endoftext|>") == np.array(library.encode("<|endoftext|>", add_special_tokens=False).ids, "<u4").tobytes()


def test_pieces_and_sequences(spark):
    library = Tokenizer.from_file(packing.vocabulary())
    library.encode_special_tokens = True
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["word", "other", "Thing", "zweí"]) for _ in range(rnd.randrange(0, 400))) for _ in range(150)]
    rows = [*enumerate(texts), (900, None), (901, ""), (None, "no id"), (0, texts[0]), (902, "very long " * 30_000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, length int")
    whole = {}
    for i, t in rows:
        whole.setdefault(i, library.encode(t or "", add_special_tokens=False).ids + [2])
    packed = packing.pack(packing.pieces(df, capacity=128), 128, group_rows=40).collect()
    assert len({i for i, _ in rows}) == len({r.doc_id for r in packed})
    for r in packed:
        ids = whole[r.doc_id]
        assert list(np.frombuffer(r.ids, "<u4")) == ids[r.start : r.start + r.length]
        assert r.length == 128 or r.piece == 0
        assert r.piece == 0 or r.start == (len(ids) - 1) % 128 + 1 + 128 * (r.piece - 1)
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 128
    total = sum(r.length for r in packed)
    assert sum(len(v) for v in whole.values()) + len(whole[0]) == total
    assert len(by_sequence) <= 1.05 * total / 128 + 4
    assert packing.pack(packing.pieces(df.limit(0))).count() == 0


def test_sequences_hold_the_packed_ids(spark, folder):
    packed = packing.pack(packing.pieces(table(spark, folder, "documents")))
    rows = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in rows) == 4 * packed.agg(F.sum("length")).first()[0]
    assert all(len(r.ids) <= 4096 and r.starts[0] == 0 for r in rows)


def test_digest_of_a_query_row(spark, folder):
    library = Tokenizer.from_file(packing.vocabulary())
    texts = {r.doc_id: r.text for r in table(spark, folder, "documents").collect()}
    for r in catalogue.QUERIES["op4_sum_of_squares_packing"](spark, folder).collect():
        ids = (library.encode(texts[r.doc_id], add_special_tokens=False).ids + [2])[r.start : r.start + r.length]
        assert len(ids) == r.length and zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32


# Dialogues


def test_every_participant_is_the_assistant_once(spark):
    rows = [(1, 0, "system", "be kind", 1), (1, 1, "ann", "hi <|end|> all", 1), (1, 2, "bob", None, 1), (1, 3, "ann", "bye", 1), (1, 3, "ann", "bye", 1), (1, 70, "eve", "late", 1), (2, 0, "system", "alone", 1), (None, None, "zoe", "lost", 1), (3, 0, None, "who", 1), (3, 1, "ann", "me", 1)]
    got = {(r.conv_id, r.perspective, r.part): r for r in chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, mask int")).collect()}
    assert set(got) == {(1, p, k) for p in ("ann", "bob", "eve") for k in (0, 1)} | {(None, "zoe", -1), (3, "ann", 0)}
    ann = got[1, "ann", 0]
    assert ann.text == "<|start|>system\nbe kind<|end|>\n<|start|>assistant\nhi < |end|> all<|end|>\n<|start|>user name=bob\n<|end|>\n<|start|>assistant\nbye<|end|>\n"
    assert (ann.n_turns, ann.n_own) == (4, 2)
    spans = [tuple(map(int, s.split(":"))) for s in ann.mask.split(",")]
    assert [ann.text[a:b] for a, b in spans] == ["hi < |end|> all<|end|>", "bye<|end|>"]
    assert got[1, "bob", 1].mask == "" and got[1, "bob", 1].text.startswith("<|start|>user name=eve\n")
    assert got[3, "ann", 0].text.startswith("<|start|>user\nwho")
    assert chat.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_a_crowded_part_is_split(spark):
    rows = [(1, None if k % 2 else 5, f"p{k % 2}", f"text {k}") for k in range(900)]
    got = chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), part_rows=100).collect()
    assert max(r.n_turns for r in got) < 250
    assert sum(r.n_turns for r in got if r.perspective == "p0") == 900


def test_splits_in_order_are_the_dialogue(spark):
    rows = [(conv, turn, f"p{k % 2}", f"text {k}") for conv in (1, None) for turn in (5, 7, None) for k in range(150)]
    rows += [(1, 9, None, "nobody"), (2, 0, "p0", "alone")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    whole = {(r.conv_id, r.perspective, r.part): r for r in chat.rotate(turns, part_rows=1000).collect()}
    splits = {}
    for r in sorted(chat.rotate(turns, part_rows=40).collect(), key=lambda r: r.split):
        splits.setdefault((r.conv_id, r.perspective, r.part), []).append(r)
    assert splits.keys() == whole.keys() and {k[2] for k in whole} == {0, -1}
    for key, parts in splits.items():
        assert [r.split for r in parts] == list(range(len(parts))) and all(r.n_turns == 40 for r in parts[:-1])
        assert "".join(r.text for r in parts) == whole[key].text
        assert sum(r.n_own for r in parts) == whole[key].n_own


# URLs


def test_verdicts(spark):
    urls = [
        "HTTP://WWW.Example.com/en/x?q=1", "https://example.com/en/x", "https://a.example.com/en/", "https://example.com", "https://b.net/es/1#f", "https://net/fr/", "https://notexample.com/en/",
        "no scheme", None, "", "://", "x://?q", "https://bad.org/p/", "http://www.bad.org:80/p?x#y", "https://bad.org/P", "https://b.net/fr/", "https://É.net/es/",
    ]
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate([*urls, urls[12]])], "page_id long, url string, rule string")
    listed = spark.createDataFrame([("https://bad.org/p",), ("http://bad.org/p/",), ("https://b.net/es/1",), (None,), ("no",)], "url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, listed).collect()}
    expected = [
        ("www.example.com", "/en/x", "www.example.com/en/", "allow"), ("example.com", "/en/x", "example.com/en/", "block"), ("a.example.com", "/en/", "example.com/en/", "block"),
        ("example.com", "", None, "allow"), ("b.net", "/es/1", "net/es/", "block"), ("net", "/fr/", "net/fr/", "block"), ("notexample.com", "/en/", "com/", "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("bad.org", "/p/", None, "block"), ("www.bad.org:80", "/p", None, "block"), ("bad.org", "/P", None, "allow"), ("b.net", "/fr/", "net/fr/", "block"), ("É.net", "/es/", "net/es/", "block"), ("bad.org", "/p/", None, "block"),
    ]
    assert [got[k] for k in range(len(expected))] == expected
    assert url_filter.judge(pages, listed.limit(0)).where("listed").count() == 0
    assert url_filter.judge(pages.limit(0), listed).count() == 0


def test_verdicts_that_only_a_list_decides(spark):
    labels = ["cheap-pills", "casino-win", "spam-farm", "free-bets", "ads-track", "adult-x"]
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    listed = url_filter.listed_pages(pages)
    judged = url_filter.judge(pages, listed).join(pages.select("page_id", "url"), "page_id").collect()
    without = {r.page_id: r.verdict for r in url_filter.judge(pages, listed.limit(0)).collect()}
    on = lambda r: any(label in r.host.split(".") for label in labels)
    same_page = {r.canonical for r in judged if on(r)}
    assert all(r.listed == (r.canonical in same_page) for r in judged)
    assert all(r.verdict == ("block" if r.rule is None and r.listed else without[r.page_id]) for r in judged)
    by_list = [r for r in judged if r.verdict != without[r.page_id]]
    assert by_list and all(r.rule is None and r.listed for r in by_list)


def test_filter_has_no_false_negatives_and_a_bound(spark):
    from newsmill.llm.bloom import Filter

    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    filter_ = Filter(keys, "key")
    assert filter_.mark(keys, F.col("key"), "m").where("NOT m").count() == 0
    other = spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("key"))
    assert filter_.mark(other, F.col("key"), "m").where("m").count() < 600
    assert filter_.table.count() <= filter_.blocks == 5000


# WARC


def test_derivatives_and_round_trip(spark, tmp_path):
    html = '<html><head><title> A &amp; B </title><style>p{}</style></head><body><script>var x="<p>";</script><!-- c --><p>One<br>two &lt;3</p><a href="/x?a=1&amp;b=2">go</a></body></html>'
    rows = [(1, "http://a.org/", html, "x"), (2, None, None, "x"), (3, "http://b.org/", "", "x"), (3, "http://b.org/", "", "x"), (None, "http://c.org/", "<p>" + "long " * 40_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, content string")
    source = warc.responses(pages, "2026-01-01T00:00:00Z")
    made = warc.derive(source, keep=["page_id"])
    got = made.collect()
    assert len(got) == 2 * len(rows)
    ids = {r.record_id: r for r in source.collect()}
    assert all(r.refers_to in ids and r.payload_digest == ids[r.refers_to].payload_digest and r.target_uri == ids[r.refers_to].target_uri for r in got)
    one = {r.record_type: r for r in got if r.page_id == 1}
    assert one["conversion"].content == "One\ntwo <3\ngo"
    assert one["metadata"].content == f"source-header: HTTP/1.1 200 OK\r\nsource-header: Content-Type: text/html; charset=utf-8\r\nsource-header: Content-Length: {len(html)}\r\ntitle: A & B\r\noutlink: /x?a=1&b=2\r\n"
    assert all(r.content_length == len(r.content.encode()) for r in got)
    warc.write(made, str(tmp_path / "w"))
    back = warc.read(spark, str(tmp_path / "w")).collect()
    assert len(back) == len(got) and all(r.whole for r in back)
    assert sorted((r.headers["WARC-Record-ID"], r.headers["WARC-Refers-To"], r.headers["WARC-Block-Digest"], r.content) for r in back) == sorted((r.record_id, r.refers_to, r.block_digest, r.content) for r in got)
    assert warc.derive(source.limit(0)).count() == 0


def test_all_character_references_are_decoded(spark):
    # lang and rang are other brackets in the table of names than in HTML 5.
    refs = " ".join(f"&{n};" for n in sorted(name2codepoint) if n not in ("nbsp", "lang", "rang")) + " &apos; &#8212; &#x2014; &#128512; &amp;copy; &nosuch; A&nbsp;B"
    pages = spark.createDataFrame([(1, "http://a.org/", f'<title>{refs}</title><p>{refs}</p><a href="/x?q=&eacute;&#38;r">go</a>')], "page_id long, url string, html string")
    got = {r.record_type: r.content for r in warc.derive(warc.responses(pages, "2026-01-01T00:00:00Z")).collect()}
    expected = html.unescape(refs.replace("&nbsp;", " "))
    assert got["conversion"] == f"{expected}\ngo"
    assert f"title: {expected}\r\n" in got["metadata"] and "outlink: /x?q=é&r\r\n" in got["metadata"]


def test_texts_are_stripped_once_a_row(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a &amp; b</p>")], "page_id long, url string, html string")
    plan = warc.derive(warc.responses(pages, "2026-01-01T00:00:00Z"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<script") == 1 and plan.count("<title[^>]*>(.*?)") == 1


def test_lines_without_references_or_runs_need_no_pattern(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>")], "page_id long, url string, html string")
    plan = warc.derive(warc.responses(pages, "2026-01-01T00:00:00Z"))._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(split(_nm_bare" in plan


def test_blanks_and_lines_of_a_text(spark):
    html = " \t<p> a \t b&#32;&#10; &#9;\r\nc&nbsp;</p>\f<b>d</b>  <i>e\x0b</i><br>&nbsp;<br>&#13;<li>f&amp;#10;g <p>&#10;"
    pages = spark.createDataFrame([(1, "u", html), (2, "u", " \n<p>\t</p>"), (3, "u", None)], "page_id long, url string, html string")
    got = {r.page_id: r.content for r in warc.derive(warc.responses(pages, "d"), keep=["page_id"]).where("record_type = 'conversion'").collect()}
    assert got == {1: "a b\nc\nd e\x0b\n\r\nf&#10;g", 2: "", 3: ""}


def test_responses_without_a_body(spark):
    df = spark.createDataFrame([("<urn:uuid:1>", "u", "d", "p", None), ("<urn:uuid:2>", "u", "d", "p", "HTTP/1.1 404 Not Found")], "record_id string, target_uri string, date string, payload_digest string, block string")
    got = {(r.refers_to, r.record_type): r.content for r in warc.derive(df).collect()}
    assert got["<urn:uuid:2>", "metadata"].startswith("source-header: HTTP/1.1 404 Not Found\r\n") and got["<urn:uuid:1>", "conversion"] == ""
