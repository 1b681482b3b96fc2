"""The corpus run against a version in plain Python, and its stages on odd rows."""

import re
import zlib

import duckdb
import numpy as np
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from newsmill.llm import compression_rules, packing
from tests.llm.test_llm_near_duplicates import brute_components
from tests.llm.test_llm_text_filters import brute_counts, brute_spans


def plain_run(docs, items):
    """Ids and final texts of the documents that stay."""
    compressor = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)

    def good(text):
        words, _, _, _, repeated = brute_counts(text)
        raw = text.encode()
        inside = compression_rules.compression(raw, compressor, compression_rules.BANDS, compression_rules.CHUNK_BYTES, compression_rules.CHUNK_LIMITS, compression_rules.CHUNK_SHARE)[3]
        return inside and words >= 10 and 100 * repeated <= 20 * words

    docs = [(i, t) for i, t in docs if good(t)]
    labels, _ = brute_components(docs, 5, 80)
    docs = [(i, t) for i, t in docs if labels[i] == i]
    bare = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    needles = [bare(t) for t in items]
    docs = [(i, t) for i, t in docs if not any(n in bare(t) for n in needles)]
    out = {}
    for i, t in docs:
        spans = sorted((int(a), -int(b), kind) for kind, a, b in (s.split(":") for s in brute_spans(t).split(",") if s))
        text, at = "", 0
        for start, stop, kind in spans:
            if start >= at:
                text += t[at:start] + f"[{kind.upper()}]"
            at = max(at, -stop)
        out[i] = text + t[at:]
    return out


def test_run_as_in_plain_python(spark, folder):
    con = duckdb.connect()
    docs = con.execute(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()
    items = [t for (t,) in con.execute(f"SELECT text FROM '{folder}/benchmark.parquet'").fetchall()]
    library = Tokenizer.from_file(packing.vocabulary())
    expected = {}
    for i, text in plain_run(docs, items).items():
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        expected |= {(i, k): (a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))}
    rows = corpus_pipeline.run(spark, folder).collect()
    assert len(rows) == len(expected)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected


def test_stages_on_odd_rows(spark, folder):
    prose = spark.read.parquet(f"{folder}/documents.parquet").where("n_chars BETWEEN 300 AND 3000").orderBy("doc_id").first().text
    rows = [(1, prose), (1, prose), (2, prose), (None, prose), (None, None), (3, None), (4, ""), (5, prose + " mail bob@x.org"), (6, "short")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, component_id int, _x boolean"
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "k", 7, True) for i, t in rows], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), folder).count() == 0, name
    stages = dict(corpus_pipeline.STAGES)
    kept = lambda name: sorted((r.doc_id or 0, r.text or "") for r in stages[name](spark, docs, folder).collect())
    assert kept("quality_rules") == [(0, prose), (1, prose), (1, prose), (2, prose), (5, prose + " mail bob@x.org")]
    assert kept("near_duplicates") == [(0, ""), (0, prose), (1, prose), (3, ""), (4, ""), (6, "short")]
    assert len(kept("decontamination")) == len(rows)
    clean = {r.doc_id: r for r in stages["personal_data"](spark, docs.where("doc_id >= 3"), folder).collect()}
    assert clean[5].text == prose + " mail [EMAIL]" and clean[5].n_chars == len(clean[5].text) and clean[3].n_chars is None
    assert stages["packing"](spark, docs, folder).agg(F.countDistinct("doc_id")).first()[0] == 6
