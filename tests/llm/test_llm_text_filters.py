"""Compression bands, compression scores, decontamination and personal data."""

import base64
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from newsmill.llm import compression_rules, compression_score, decontaminate, disclosure
from newsmill.session import table


# Compression bands


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    covered = set()
    for k, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= set(range(k, k + 5))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é\n\t\x0b\x0c\r\x1c\x85#|<　😀")), max_size=120))
def test_counts_as_by_brute_force(text):
    assert compression_rules.base_counts(text.encode()) == brute_counts(text)


def test_repeated_words_with_many_distinct_ones():
    words = [str(k).encode() for k in range(20_000)]
    assert compression_rules.repeated_words(words + words[:7]) == 14


def test_verdicts(spark):
    rnd = random.Random(2)
    prose = " ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(2, 9))) for _ in range(900))
    noise = " ".join("".join(chr(rnd.randrange(0x4E00, 0x9FFF)) for _ in range(12)) for _ in range(200))
    half = " ".join(f"aa{k % 10}b{k // 10}" for k in range(2500))
    rows = [(1, prose, 1), (2, "same " * 300, 2), (3, noise, 3), (4, None, 4), (5, "", 5), (None, "few words", 6), (7, half, 7)]
    got = {r.doc_id: r for r in compression_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, kept int")).collect()}
    assert len(got) == 7
    assert [got[k].kept for k in (1, 2, 3, 4, 5, None, 7)] == [True, False, False, False, False, False, False]
    assert got[2].base_failed and not got[3].base_failed and got[4].n_words == 0 and got[4].ratio is None
    plain = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
    assert got[1].ratio == len(plain.compress(prose.encode())) / len(prose.encode())
    assert got[1].n_chunks == len(prose.encode()) // compression_rules.CHUNK_BYTES
    assert got[7].n_bad_chunks > got[7].n_chunks / 2
    assert compression_rules.passing(spark.createDataFrame(rows, "doc_id long, text string, kept int")).columns == ["doc_id", "text", "kept"]
    assert compression_rules.judge(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def spaced_noise(rnd, size):
    raw = base64.b64encode(rnd.randbytes(size))[:size]
    return b" ".join(raw[k : k + 20] for k in range(0, size, 20))[:size]


@pytest.mark.parametrize("top", [top for top, _, _ in compression_rules.BANDS[1:]])
def test_noise_of_every_length_is_outside(top):
    compressor = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
    rnd, tops = random.Random(9), [b[0] for b in compression_rules.BANDS]
    below = tops[tops.index(top) - 1]
    for size in {below + 1, (below + (top or 200_000)) // 2, top or 200_000}:
        raw = spaced_noise(rnd, size)
        ratio = len(compressor.compress(raw)) / len(raw)
        assert compression_rules.limits_for(len(raw), compression_rules.BANDS)[1] < ratio
        assert not compression_rules.compression(raw, compressor, compression_rules.BANDS, 10**9, (0, 9), 1)[3]


def test_kept_as_by_brute_force_and_clean_prose_stays(spark):
    folder = "/root/testdata/sf0.001"
    plain = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall())

    def kept(raw):
        share = lambda part: len(plain.compress(part)) / len(part)
        n_words, _, _, _, repeated = brute_counts(raw.decode())
        low, high = next((lo, hi) for top, lo, hi in compression_rules.BANDS if top is None or len(raw) <= top)
        parts = [raw[k : k + 2048] for k in range(0, len(raw) - 2047, 2048)]
        parts += [raw[-2048:]] if parts and len(raw) % 2048 else []
        bad = [p for p in parts if not 0.43 <= share(p) <= 0.65]
        return n_words >= 10 and 100 * repeated <= 20 * n_words and low <= share(raw) <= high and 10 * len(bad) <= len(parts)

    got = {r.doc_id: r.kept for r in compression_rules.judge(table(spark, folder, "documents")).collect()}
    assert got == {k: kept(t.encode()) for k, t in texts.items()}
    labels = dict(duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    rows = compression_rules.judge(table(spark, "/root/testdata/sf0.01", "documents")).collect()
    assert all(r.kept for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed)


def test_noise_inside_prose_is_seen_by_chunks():
    compressor = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
    rnd = random.Random(7)
    prose = lambda n: " ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(2, 9))) for _ in range(n)).encode()[:n]
    noise = lambda n: base64.b64encode(rnd.randbytes(n))[:n]
    limits = compression_rules.BANDS, compression_rules.CHUNK_BYTES, compression_rules.CHUNK_LIMITS, compression_rules.CHUNK_SHARE
    for raw, inside in [
        (prose(60_000), True), (prose(50_000) + noise(10_000), False), (noise(10_000) + prose(50_000), False),
        (prose(7 * 2048) + noise(2047), False), (prose(7 * 2048 + 2047), True), (prose(2048), True),
    ]:
        ratio, n, bad, kept = compression_rules.compression(raw, compressor, *limits)
        low, high = compression_rules.limits_for(len(raw), compression_rules.BANDS)
        assert low <= ratio <= high  # the whole text is inside; the chunks decide
        assert (n, bad > 0, kept) == (len(raw) // 2048, not inside, inside)


def test_clean_documents_pass(spark, folder):
    judged = compression_rules.judge(table(spark, folder, "documents")).join(table(spark, folder, "labels"), "doc_id")
    good = judged.where("quality = 1 AND NOT base_failed")
    assert good.count() > 0 and good.where("NOT kept").count() == 0


# Compression scores


def test_scores_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    scored = compression_score.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    rows = scored.collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    labelled = scored.where("held_out").join(table(spark, folder, "labels"), "doc_id").collect()
    pairs = [(g.score > b.score) + 0.5 * (g.score == b.score) for g in labelled if g.quality for b in labelled if not b.quality]
    assert sum(pairs) / len(pairs) > 0.85


def test_labels_of_held_out_rows_do_not_matter(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(compression_score.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    same = lambda l: {r.doc_id: r.score for r in compression_score.scores(docs, l).collect()}
    assert same(labels) == same(turned)


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, 1), (2, 0)], [(1, 0), (1, 1), (None, 1), (2, None)]])
def test_scores_with_few_labels(spark, labels):
    docs = spark.createDataFrame([(1, "good words here", 1), (2, "bad words there", 1), (None, None, 1), (4, "", 1), (4, "", 1)], "doc_id long, text string, score int")
    rows = compression_score.scores(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert compression_score.scores(docs.limit(0), spark.createDataFrame(labels, "doc_id long, quality int")).count() == 0


# Decontamination


def test_overlaps_with_changed_words(spark):
    rnd = random.Random(4)
    vocab = [f"v{k}" for k in range(5000)]
    words = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = {k: words(40) for k in range(30)}
    docs, expected = [], set()
    for d in range(60):
        text = words(150)
        if d < 30:
            part = list(items[d])
            for k in rnd.sample(range(40), 5):  # one word in eight changed
                part[k] = "changed"
            text[50:50] = part
            expected.add((d, d))
        docs.append((d, " ".join(text).upper() if d % 2 else ", ".join(text), "x"))
    docs += [(100, None, "x"), (101, "", "x"), (None, " ".join(items[3]), "x"), (None, " ".join(items[3]), "x"), (102, " ".join(words(60_000) + items[7]), "x")]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()] + [(900, None), (901, "not there"), (3, " ".join(items[3]))], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    found = decontaminate.overlaps(df, bench)
    rows = found.collect()
    assert {(r.doc_id, r.item_id) for r in rows} == expected | {(None, 3), (102, 7)}
    assert len(rows) == len(expected) + 2
    whole = next(r for r in rows if r.doc_id == 102)
    assert (whole.doc_start, whole.item_start, whole.n_words, whole.n_equal) == (60_000, 0, 40, 40)
    clean = decontaminate.clean_of(df, found)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {*range(30, 60), 100, 101}


def test_stretches_as_by_brute_force():
    rnd, found = random.Random(12), 0
    for _ in range(1500):
        n, shift = rnd.randrange(12, 41), rnd.randrange(-6, 7)
        item = np.arange(n, dtype=np.uint64)
        doc = np.concatenate([np.full(max(shift, 0), 900, np.uint64), item[max(-shift, 0) :], np.full(rnd.randrange(3), 901, np.uint64)])
        doc[[k for k in range(len(doc)) if rnd.random() < rnd.choice([0.1, 0.25])]] = 999
        lo, hi = max(0, -shift), min(n, len(doc) - shift)
        same = [bool(doc[k + shift] == item[k]) for k in range(lo, hi)]
        fits = {(a, b) for a in range(len(same)) for b in range(a + 12, len(same) + 1) if 4 * sum(same[a:b]) >= 3 * (b - a)}
        start, length, equal = decontaminate.best_overlap(doc, item, shift, 12, 0.75)
        assert (length > 0) == bool(fits)
        if fits:
            found += 1
            a, b = start - lo, start - lo + length
            assert (a, b) in fits and equal == sum(same[a:b])
            assert 4 * equal - 3 * length == max(4 * sum(same[a:b]) - 3 * (b - a) for a, b in fits)
    assert 100 < found < 1500


def test_a_run_of_equal_words_hides_no_longer_overlap(spark):
    item = [f"i{k}" for k in range(16)]
    part = [*item[:11], "other", *item[12:15], "words"]
    text = [*[f"a{k}" for k in range(30)], *part, *[f"b{k}" for k in range(30)]]
    docs = spark.createDataFrame([(1, " ".join(text))], "doc_id long, text string")
    found = decontaminate.overlaps(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string"))
    row = found.first()
    assert (row.doc_id, row.item_id, row.doc_start, row.item_start, row.n_words, row.n_equal) == (1, 7, 30, 0, 15, 14)
    assert decontaminate.clean_of(docs, found).count() == 0


def test_random_overlaps_are_found(spark):
    """Recall of at least 0.9 for every length and share of changed words."""
    rnd = random.Random(8)
    vocab = [f"v{k}" for k in range(3000)]
    words = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items, docs, cells = [], [], {}
    for length in (12, 14, 16, 20, 24, 30, 40):
        for share in (0.1, 0.15, 0.2, 0.25):
            for _ in range(40):
                k = len(items)
                part = words(length)
                items.append((k, " ".join(part)))
                for at in rnd.sample(range(length), int(length * share)):
                    part[at] = "changed"
                docs.append((k, " ".join(words(40) + part + words(40))))
                cells.setdefault((length, share), []).append(k)
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(df, bench).collect()}
    # An overlap whose ends are changed is shorter than 12 words without them; those of 12 words may lose theirs.
    recall = {cell: sum((k, k) in found for k in ids) / len(ids) for cell, ids in cells.items()}
    assert min(recall.values()) >= 0.9, recall
    assert found <= {(k, k) for k, _ in items}


def test_short_items_are_found_as_exact_copies(spark):
    items = [(1, "One"), (2, "two three"), (3, "a b c d e"), (4, "six words are in this item"), (5, "nine words are in this item so it says"), (6, ""), (7, "!!"), (2, "two three")]
    docs = [(1, "one " * 5000), (2, "two, THREE and one"), (3, "three two"), (4, "x a b c d e y"), (5, "a b c d"), (6, "here six words are in this item too"), (7, "nine words are in this item so it says"), (None, "two three"), (8, None)]
    schema = "doc_id long, text string"
    found = decontaminate.overlaps(spark.createDataFrame(docs, schema), spark.createDataFrame(items, "item_id long, text string"))
    rows = sorted(((r.doc_id or 0, r.item_id, r.doc_start, r.n_words, r.n_equal) for r in found.collect()))
    assert rows == [(0, 2, 0, 2, 2), (1, 1, 0, 1, 1), (2, 1, 3, 1, 1), (2, 2, 0, 2, 2), (4, 3, 1, 5, 5), (6, 4, 1, 6, 6), (7, 5, 0, 9, 9)]
    assert decontaminate.clean_of(spark.createDataFrame(docs, schema), found).count() == 3


def test_no_documents_or_items(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.overlaps(docs, none).count() == 0
    assert decontaminate.overlaps(docs.limit(0), spark.createDataFrame([(1, "a " * 40)], "item_id long, text string")).count() == 0


def test_whole_benchmark_passages_are_found(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    items = con.execute(f"SELECT item_id, text FROM '{folder}/benchmark.parquet'").fetchall()
    docs = con.execute(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    needles = [(i, plain(t)) for i, t in items]
    expected = {(d, i) for d, t in docs for i, n in needles if n in plain(t)}
    found = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark")).collect()}
    assert expected and expected <= found
    assert {d for d, _ in found} == {d for d, _ in expected}


# Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and not all(int(p) <= 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_spans_as_by_brute_force(spark):
    rnd = random.Random(8)
    cards = ["4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005", "6304000000000000", "4111111111111111"]
    bits = ["a@b.c", "x.y+z@mail-1.example.com", "@", "a@b", "_", "-", ".", " ", "\n", "😀", "é", "1.2.3.4", "256.1.1.1", "001.02.3.255", "1.2.3", "+1 (743) 555-3824", "+", "+49.", *cards, "12", "3", "word", "(", ")"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(0, 14))) for _ in range(3000)]
    texts += ["a@b.c_d@e.f", "foo@bar@baz.com", "1.2.3.4.5.6.7.8.9", "a" * 50_000, "1" * 50_000, "a@" + "b." * 20_000, "+1" + " ." * 20_000, "1-" * 30_000 + "1", ".1" * 30_000]
    texts += [f"{c} {c}" for c in cards] + [f"x{c}-{c}" for c in cards]
    found = disclosure.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: r for r in disclosure.counts(found.withColumn("spans", found["base"])).collect()}
    for k, t in enumerate(texts):
        assert got[k].spans == brute_spans(t), repr(t[:200])
        assert got[k].base_sha256 == hashlib.sha256(brute_spans(t).encode()).hexdigest()


def test_terms_that_reveal_an_entity(spark):
    rnd = random.Random(3)
    filler = lambda n: " ".join(f"word{rnd.randrange(40)}" for _ in range(n))
    rows = [(k, f"{filler(30)} Zanzibor of the common office {filler(3)} bob@x.org {filler(30)} zanzibor.") for k in range(4)]
    rows += [(10 + k, f"{filler(30)} the common office {filler(30)}") for k in range(200)]
    rows += [(300, "Zanzibor without an address"), (301, None), (302, ""), (None, "mail amy@y.org"), (303, rows[0][1])]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, spans string")
    found = {r.doc_id: r for r in disclosure.counts(disclosure.find(docs, remove=0.99)).collect()}
    assert len(found) == len(rows)
    text = dict(rows)[0]
    at, last = text.index("Zanzibor"), text.index("zanzibor")
    mail = text.index("bob@")
    assert found[0].spans == f"email:{mail}:{mail + 9},generalise:{at}:{at + 8},generalise:{last}:{last + 8}"
    assert found[0].n_email == 1 and found[300].spans == "" and found[10].spans == "" and found[301].spans == ""
    out = {r.doc_id: r.text for r in disclosure.sanitise(docs, remove=0.99).collect()}
    assert out[0] == text.replace("Zanzibor", "[NAME]").replace("zanzibor", "[TERM]").replace("bob@x.org", "[EMAIL]")
    assert out[301] is None and out[302] == "" and out[None] == "mail [EMAIL]" and out[300] == "Zanzibor without an address"
    assert disclosure.sanitise(docs).columns == docs.columns


def test_terms_far_from_an_entity_count(spark):
    rnd = random.Random(5)
    filler = lambda n: " ".join(f"word{rnd.randrange(40)}" for _ in range(n))
    near = [f"{filler(30)} Zanzibor {filler(3)} bob@x.org {filler(30)}" for _ in range(6)]
    far = [f"Zanzibor {filler(40)} bob@x.org {filler(30)}" for _ in range(14)]
    never_near = [f"Quillon {filler(40)} {filler(20)} amy@y.org" for _ in range(5)]
    rows = list(enumerate([*near, *far, *never_near, *[filler(50) for _ in range(400)]]))
    rows += [rows[0], rows[0]]  # rows that repeat count on both sides
    spans = {r.doc_id: r.spans for r in disclosure.counts(disclosure.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    for k, text in rows[:25]:
        name = "Zanzibor" if k < 20 else "Quillon"
        assert f"remove:{text.index(name)}:{text.index(name) + len(name)}" in spans[k].split(",")
        assert spans[k].count("remove") == 1 and "generalise" not in spans[k]
    assert not any(spans[k] for k in range(25, 425))


def test_copies_are_no_evidence(spark):
    text = "rarename writes from bob@x.org today"
    docs = spark.createDataFrame([(k, text) for k in range(20)] + [(100 + k, f"other text {k}") for k in range(50)], "doc_id long, text string")
    assert disclosure.counts(disclosure.find(docs)).where("spans <> 'email:21:30' AND doc_id < 100").count() == 0


def test_overlapping_spans_are_replaced_once(spark):
    text = "call +4111 1111 1111 1111 now"
    assert brute_spans(text) == "card:6:25"
    docs = spark.createDataFrame([(1, "x 1.2.3.4@b.co y")], "doc_id long, text string")
    assert disclosure.sanitise(docs).first().text == "x [EMAIL] y"
    assert disclosure.find(docs.limit(0)).count() == 0
