"""Upserts in place, layout by several columns, chunk profiles and phrase books."""

import os
import re
from collections import Counter

from pyspark.sql import functions as F

from newsmill.operators import phrasebook
from newsmill.sources import buckets, layout, profiles


def files(path):
    return {os.path.join(folder, n) for folder, _, names in os.walk(path) for n in names if n.endswith(".parquet") and "/_buckets" not in folder}


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = f"{tmp_path}/t"
    buckets.create(spark.range(200).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(1).alias("w")), path, "k", 8)
    before = files(path)
    rows = spark.createDataFrame([(5, "new", 2, 1), (5, "newer", 3, 2), (900, "added", 4, 1), (None, "x", 5, 1)], "k long, v string, w int, seq int")
    touched = buckets.upsert_into(rows, path, ["seq"])
    after = files(path)
    assert 1 <= len(touched) <= 2 and len(before & after) == len(before) - len(touched)
    got = {r.k: (r.v, r.w) for r in buckets.read(spark, path).collect()}
    assert len(got) == 201 and got[5] == ("newer", 3) and got[900] == ("added", 4) and got[6] == ("old", 1)
    assert buckets.upsert_into(rows, path, ["seq"]) == touched and buckets.read(spark, path).count() == 201  # once more
    buckets.merge_into(spark.createDataFrame([(6, "field")], "k long, v string"), path)
    assert {r.k: (r.v, r.w) for r in buckets.read(spark, path).where("k IN (6, 7)").collect()} == {6: ("field", 1), 7: ("old", 1)}
    assert buckets.upsert_into(rows.limit(0), path) == []


def test_files_can_be_skipped_for_each_column(spark, tmp_path):
    df = spark.range(20_000).select(F.col("id"), (F.xxhash64("id") % 1000).alias("a"), F.concat(F.lit("n"), F.lpad((F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(500))).cast("string"), 4, "0")).alias("b"), F.when(F.col("id") % 50 != 0, F.rand(1)).alias("c"))
    layout.write_clustered(df, f"{tmp_path}/t", ["a", "b"], 64)
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert stored.count() == 20_000 and sorted(stored.columns) == ["a", "b", "c", "id"]
    limits = stored.groupBy(F.input_file_name().alias("f")).agg(F.min("a").alias("la"), F.max("a").alias("ha"), F.min("b").alias("lb"), F.max("b").alias("hb")).collect()
    assert len(limits) >= 32
    for low, high, values in (("la", "ha", [-900, 0, 777]), ("lb", "hb", ["n0001", "n0250", "n0499"])):
        for v in values:
            assert sum(r[low] <= v <= r[high] for r in limits) <= 0.4 * len(limits)
    layout.write_clustered(df.select("c", F.lit(None).cast("string").alias("d"), "id"), f"{tmp_path}/n", ["c", "d"], 8)
    assert spark.read.parquet(f"{tmp_path}/n").count() == 20_000


def test_profiles_read_new_chunks_only(spark, tmp_path):
    def rows(chunks):
        return spark.range(3000).select(F.explode(F.array(*[F.lit(c) for c in chunks])).alias("chunk"), (F.col("id") % 700).alias("a"), F.when(F.col("id") % 3 == 0, float("nan")).otherwise(F.col("id") / 7).alias("b"), F.concat(F.lit("t"), F.col("id") % 40).alias("c"))

    path = f"{tmp_path}/p"
    profiles.add_chunks(rows(["x", "y"]), path, "chunk")
    # A stored chunk that is read again would fail here.
    broken = rows(["x", "y", "z"]).withColumn("a", F.when(F.col("chunk") == "z", F.col("a")).otherwise(F.raise_error(F.lit("read again")).cast("long")))
    profiles.add_chunks(broken, path, "chunk")
    got = {r["column"]: r for r in profiles.profile(spark, path, [0.5]).collect()}
    assert {n: (got[n]["rows"], got[n]["values"]) for n in got} == {"a": (9000, 9000), "b": (9000, 6000), "c": (9000, 9000)}
    assert abs(got["a"].distinct - 700) <= 21 and got["c"].distinct == 40 and abs(got["a"].q50 - 325) <= 0.01 * 700 + 1
    assert got["c"].q50 is None and got["b"].low == 1 / 7


def test_phrases_as_by_pattern(spark, monkeypatch):
    texts = [(1, "The cat sat. the  cat, THE CAT's cat"), (2, "concat the cat_ cat"), (3, None), (4, ""), (5, "naïve café, café"), (5, "cat"), (6, "aa aa aa")]
    phrases = ["cat", "the cat", " CAFÉ ", "café", None, "", "cat's", "aa aa", ".", "missing", "t. t"]
    df, book = spark.createDataFrame(texts, "record_id long, content_text string"), spark.createDataFrame([(p,) for p in phrases], "p string")
    want = Counter()
    for k, text in texts:
        for p in {p.strip().lower() for p in phrases if p and p.strip()}:
            pattern = (r"(?<!\w)" if re.match(r"\w", p) else "") + re.escape(p) + (r"(?!\w)" if re.search(r"\w$", p) else "")
            want[k, p] += len(re.findall(f"(?={pattern})", (text or "").lower()))
    for most in (200_000, 2):
        monkeypatch.setattr(phrasebook, "PHRASES", most)
        got = {(r.record_id, r.phrase): r.times for r in phrasebook.phrase_counts(df, book, "p").collect()}
        assert got == {k: n for k, n in want.items() if n}
