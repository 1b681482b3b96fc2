import numpy as np
import pytest
from pyspark.sql import functions as F

from newsmill.functions import vectors
from newsmill.operators import search


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)], i % 3) for i in range(200)]
    return rows, spark.createDataFrame(rows, "id long, embedding array<float>, label int").repartition(7)


def cosine(a, b):
    size = np.linalg.norm(a) * np.linalg.norm(b)
    return float(np.dot(a, b) / size) if size else 0.0


def test_nearest_against_brute_force_with_many_ties(points):
    rows, df = points
    queries = {"a": [1.0, 0.0, 0.0, 0.0], "b": [1.0, 1.0, -1.0, 2.0], "zero": [0.0] * 4}
    found = search.nearest(df, queries, 9, where={"label": {"$in": [0, 1]}}).collect()
    for name, q in queries.items():
        ranked = sorted(((-round(cosine(v, q), 12), i) for i, v, label in rows if label < 2))[:9]
        mine = sorted((r for r in found if r["query"] == name), key=lambda r: r["rank"])
        assert [(round(r["similarity_score"], 9)) for r in mine] == [pytest.approx(-s) for s, _ in ranked]
        assert len({r["id"] for r in mine}) == 9


def test_equal_vectors_rank_by_key(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)], "id long, embedding array<float>").repartition(5)
    found = search.vector_search(df, [1.0, 2.0], 4).orderBy("rank").collect()
    assert [r["id"] for r in found] == [0, 1, 2, 3]


def test_fewer_rows_than_wanted_and_gaps(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0])], "id long, embedding array<float>")
    assert [(r["id"], r["similarity_score"]) for r in search.vector_search(df, [1.0, 0.0], 10).orderBy("rank").collect()] == [(1, 1.0), (3, 0.0)]


def test_many_queries_are_answered_in_blocks(points, monkeypatch):
    with pytest.raises(ValueError):
        search.nearest(points[1], {})
    monkeypatch.setattr(search, "QUERY_BLOCK", 2)
    many = {str(i): [1.0, float(i), 0.0, 0.0] for i in range(5)}
    assert search.nearest(points[1], many, k=1).select("query").distinct().count() == 5
    assert search.similarity_to(points[1], many).count() == 5 * points[1].count()


def test_vectors_of_another_width_are_listed(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (4, [1.0])], "id long, embedding array<float>")
    assert sorted(tuple(r) for r in search.other_widths(df, 2).collect()) == [(2, None), (4, 1)]
    got = {r["id"]: r["cosine"] for r in search.similarity_to(df, {"x": [1.0, 0.0]}).collect()}
    assert got == {1: 1.0, 2: None, 4: None}


def test_similarity_to_anchors(points):
    rows, df = points
    anchors = {"x": [1.0, 2.0, 0.0, 0.0], "y": [0.0, 0.0, 0.0, 3.0]}
    found = {(r["id"], r["anchor"]): r["cosine"] for r in search.similarity_to(df, anchors).collect()}
    assert len(found) == 400
    for i, v, _ in rows:
        for name, a in anchors.items():
            assert found[i, name] == pytest.approx(cosine(v, a), abs=1e-12)


def test_measures(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 4.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    a, b = F.col("a"), F.col("b")
    found = df.select(vectors.cosine(a, b), vectors.dot(a, b), vectors.euclidean(a, b)).collect()
    assert tuple(found[0]) == (pytest.approx(1.0), 10.0, pytest.approx(np.sqrt(5))) and found[1][0] == 0.0


def test_keyword_terms_are_substrings_and_repeats_count(spark):
    rows = [(1, "Big Apple", 1.0), (2, "an apple pie", None), (3, "pie", 9.0), (4, None, 5.0), (5, "apple apple", 2.0)]
    df = spark.createDataFrame(rows, "record_id int, title string, rating_score double")
    found = search.keyword_search(df, " Apple  apple ").orderBy("rank").collect()
    assert [(r["record_id"], r["keyword_score"], r["phrase_match"]) for r in found] == [(5, 2, False), (1, 2, False), (2, 2, False)]
    assert [r["record_id"] for r in search.keyword_search(df, "apple pie").orderBy("rank").collect()] == [2, 3, 5, 1]
    assert search.keyword_search(df, "  ").count() == 0


def test_fusion(spark):
    words = spark.createDataFrame([(1, 1, "T"), (2, 2, "U")], "record_id long, rank int, title string")
    near = spark.createDataFrame([(2, 1, "u"), (3, 2, "v")], "record_id long, rank int, title string")
    found = [(r["record_id"], r["title"], r["keyword_rank"], r["semantic_rank"], r["rrf_score"]) for r in search.fuse(words, near).collect()]
    assert found == [(2, "U", 2, 1, round(1 / 62 + 1 / 61, 6)), (1, "T", 1, None, round(1 / 61, 6)), (3, "v", None, 2, round(1 / 62, 6))]
    assert [r["record_id"] for r in search.fuse(words, near.limit(0)).collect()] == [1, 2]


def test_index_load_skips_known_and_empty(spark):
    stored = spark.createDataFrame([("record_1", "x")], "id string, document string")
    more = spark.createDataFrame([("record_1", "x"), ("record_2", search.NO_DOCUMENT), ("record_3", "y")], "id string, document string")
    assert [r["id"] for r in search.rows_to_index(stored, more).collect()] == ["record_3"]
    assert tuple(search.load_counts(stored, more).first()) == (1, 2, 2)


def test_metadata_casts_and_caps(spark):
    df = spark.createDataFrame([("17", "t" * 600, "2026.9", "bad", None)], "record_id string, title string, published_year string, rating_score string, popularity double")
    row = search.metadata(df).first()
    assert (row["id"], len(row["title"]), row["year"], row["rating_score"], row["popularity"], row["language"]) == ("record_17", 500, 2026, 0.0, 0.0, "unknown")
