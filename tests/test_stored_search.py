"""Neighbours of all rows, stored vector cells and the substring index: same answers, fewer reads."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsmill.operators import neighbours, search
from newsmill.sources import cells, substrings


def vectors(spark, n, width=6, seed=1):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, width)) * 4
    rows = [(k, [float(np.float32(x)) for x in centres[k % 12] + rnd.normal(size=width) * 0.3], k % 3) for k in range(n)]
    return rows, spark.createDataFrame(rows, "id long, embedding array<float>, rank int")


def brute(rows, k):
    keys = np.array([r[0] for r in rows])
    m = np.array([r[1] for r in rows])
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    c = np.round(m @ m.T, 9)
    out = set()
    for i in range(len(rows)):
        order = [j for j in np.lexsort((keys, -c[i])) if j != i][:k]
        out |= {(int(keys[i]), r + 1, int(keys[j])) for r, j in enumerate(order)}
    return out


@pytest.mark.parametrize("k,block,asking", [(4, 4096, 16384), (4, 16, 50), (70, 16, 50)])
def test_neighbours_of_all(spark, monkeypatch, k, block, asking):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    monkeypatch.setattr(neighbours, "ASKING_ROWS", asking)
    rows, df = vectors(spark, 150)
    odd = [(1000, [0.0] * 6, 0), (1001, None, 0), (1002, [1.0, 2.0], 0), (1003, [float("nan")] * 6, 0)]
    same = [(2000 + j, rows[0][1], 0) for j in range(3)]  # ties
    got = neighbours.nearest_to_all(df.unionAll(spark.createDataFrame(odd + same, df.schema)), k)
    assert {(r.id, r["rank"], r.neighbour) for r in got.collect()} == brute(rows + same, k)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert neighbours.nearest_to_all(df.limit(0), k).count() == 0
    assert neighbours.nearest_to_all(df.where("id = 7"), k).count() == 0


def test_far_cells_are_ruled_out_and_near_ones_never(spark):
    rows, df = vectors(spark, 240)
    points = np.array([r[1] for r in rows])
    points = points / np.linalg.norm(points, axis=1, keepdims=True)
    centres = neighbours.fit_centres(df, "embedding", 6, 12)
    d = neighbours.distances(points, centres)
    radius = np.array([d[d.argmin(1) == c, c].max() for c in range(len(centres))])
    apart = neighbours.distances(points, points)
    reach = np.sort(apart, axis=1)[:, 5]
    may = neighbours.reachable(points, reach, centres, radius)
    assert may.sum(1).mean() < 3 < len(centres)
    who, whom = np.nonzero(apart <= reach[:, None])
    assert may[who, d.argmin(1)[whom]].all()


def test_stored_cells_answer_as_a_full_search(spark, tmp_path):
    rows, df = vectors(spark, 600)
    path = f"{tmp_path}/table"
    cells.create(df.where("id < 400").unionAll(spark.createDataFrame([(9000, None, 1), (9001, [0.0] * 6, 1)], df.schema)), path, cells=12)
    for load in (None, df.where("id >= 400").withColumn("embedding", F.transform("embedding", lambda x: x * F.when(F.col("id") == 599, -1.0).otherwise(1.0)).cast("array<float>"))):
        if load is not None:
            cells.append(load, path)
        whole = spark.read.parquet(path).drop("cell")
        assert whole.count() == (400 if load is None else 600)
        for q, k in ((rows[5][1], 7), ([-x for x in rows[599][1]], 3), ([1.0, 0, 0, 0, 0, 0], 399)):
            got, want = cells.search(spark, path, q, k, keep=()), search.vector_search(whole, q, k)
            assert [(r.id, r["rank"], round(r.similarity_score, 9)) for r in got.orderBy("rank").collect()] == [(r.id, r["rank"], round(r.similarity_score, 9)) for r in want.orderBy("rank").collect()]
    chosen = cells.cells_to_read(spark, path, rows[5][1], 7)
    assert len(chosen) <= 3 < len(cells.cells_of(spark, path).number)
    plan = cells.search(spark, path, rows[5][1], 7)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_more_neighbours_than_the_group_limit(spark):
    rows, df = vectors(spark, 1500)
    got = search.vector_search(df, rows[0][1], 1001)
    m = np.array([r[1] for r in rows])
    c = (m / np.linalg.norm(m, axis=1, keepdims=True)) @ (m[0] / np.linalg.norm(m[0]))
    assert [r.id for r in got.orderBy("rank").collect()] == np.lexsort((np.arange(1500), -c))[:1001].tolist()


TEXTS = [(1, "Alpha beta", "gamma"), (2, "alphabet", None), (3, None, None), (4, "", "x"), (5, "BETA\nalpha", "été"), (6, "al pha", "naïve 😀😀😀x"), (7, "bet", "gam")]


@pytest.mark.parametrize("query", ["alpha", "alpha beta", "  BETA alpha ", "phabet zzz", "gam", "été", "😀😀😀x", "al beta", "nothing here", "x"])
def test_index_answers_as_a_scan(spark, tmp_path, query):
    df = spark.createDataFrame(TEXTS, "record_id long, title string, content_text string")
    substrings.create(df, f"{tmp_path}/index")
    got = substrings.search(spark, f"{tmp_path}/index", query, 5)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, search.keyword_search(df, query, n=5).collect()))


def test_only_candidates_are_read(spark, tmp_path):
    df = spark.range(2000).select(F.col("id").alias("record_id"), F.concat(F.lit("common words "), F.when(F.col("id") == 77, "needle").otherwise("hay")).alias("title"))
    substrings.create(df, f"{tmp_path}/index")
    rows = substrings.texts_to_read(spark, f"{tmp_path}/index", "needle")
    assert [r.record_id for r in rows.collect()] == [77]
    assert rows.select(F.input_file_name()).distinct().count() == 1 < len(spark.read.parquet(f"{tmp_path}/index/texts").inputFiles())
    assert "In(record_id" in rows._jdf.queryExecution().executedPlan().toString() or "EqualTo(record_id,77)" in rows._jdf.queryExecution().executedPlan().toString()


def test_postings_are_lists_of_keys_for_a_slice_of_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(substrings, "SLICE_BYTES", 4_000)
    df = spark.range(600).select(F.col("id").alias("record_id"), F.concat(F.lit("common words "), F.col("id")).alias("title")).coalesce(1)
    substrings.create(df, f"{tmp_path}/index")
    held = spark.read.parquet(f"{tmp_path}/index/postings")
    [code] = substrings.codes_of("mon").tolist()
    keys = [k for r in held.where(F.col("gram") == code).collect() for k in r["keys"]]
    assert sorted(keys) == list(range(600)) and held.count() < 600 * len("common")
    assert len(set(substrings.codes_of("a\U0001f600b\0a\U0001f600").tolist())) == 4
    assert [r.record_id for r in substrings.texts_to_read(spark, f"{tmp_path}/index", "words 599").collect()].count(599) == 1


def test_near_cells_share_a_block():
    rnd = np.random.default_rng(3)
    near = np.repeat(np.eye(4), 5, axis=0) + rnd.normal(size=(20, 4)) * 0.01
    order = rnd.permutation(20)
    centres = near[order] / np.linalg.norm(near[order], axis=1, keepdims=True)
    counts = np.full(20, 10)
    groups = neighbours.pack_cells(centres, counts, 50)
    assert len(set(groups)) == 4 and len(set(zip(groups, order // 5))) == 4
    counts[3] = 900
    alone = neighbours.pack_cells(centres, counts, 50)
    assert (alone == alone[3]).sum() == 1 and all(counts[alone == g].sum() <= 50 for g in set(alone) - {alone[3]})
    assert neighbours.rows_of_block(600_000, 64) == 16_384 and neighbours.rows_of_block(600_000, 8_192) == 1_024
