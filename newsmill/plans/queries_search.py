"""Keyword, vector and fused search."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsmill.operators import neighbours, search
from newsmill.operators.joins import overlap
from newsmill.plans.registry import query
from newsmill.plans.stand_ins import RATED_SQL, articles, rated, rounded
from newsmill.session import scratch_path, table
from newsmill.sources import cells, substrings

_WORDS = "the ander und avec"
_BODY_SQL = "lower(title || ' ' || content_text || ' ' || category || ' ' || document_type || ' ' || source_name)"


def _keyword_sql(phrase: str, n: int) -> str:
    score = " + ".join(f"contains(b, '{t}')::INTEGER" for t in phrase.split())
    return f"""(SELECT *, CAST(row_number() OVER (ORDER BY phrase_match DESC, keyword_score DESC, rating_score DESC NULLS LAST, record_id) AS INTEGER) AS rank FROM (
      SELECT record_id, title, category, document_type, language, rating_score, {score} AS keyword_score, contains(b, '{phrase}') AS phrase_match
      FROM (SELECT *, {_BODY_SQL} AS b FROM rated)) WHERE phrase_match OR keyword_score > 0 QUALIFY rank <= {n})"""


def _near_sql(vec: int, n: int, where: str = "true") -> str:
    return f"""(SELECT vec_id AS record_id, label, s AS similarity_score, CAST(row_number() OVER (ORDER BY s DESC, vec_id) AS INTEGER) AS rank FROM (
      SELECT e.vec_id, e.label, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS s FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = {vec}) q WHERE {where})
      QUALIFY rank <= {n})"""


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("record_id"), "embedding", "label")


def _vector_of(spark, sf, vec: int) -> list[float]:
    return list(table(spark, sf, "embeddings").where(F.col("vec_id") == vec).first()["embedding"])


@query("keyword_search", 127, sql=f"WITH {RATED_SQL} SELECT *, 'keyword' AS search_type FROM {_keyword_sql(_WORDS, 25)}")
def _(spark, sf):
    return search.keyword_search(rated(spark, sf), f"  {_WORDS.title()} ", n=25)


@query("keyword_phrase_search", 127, sql=f"WITH {RATED_SQL} SELECT *, 'keyword' AS search_type FROM {_keyword_sql('of the the', 10)}")
def _(spark, sf):
    return search.keyword_search(rated(spark, sf), "of the the")


@query("vector_search", 128, sql=f"SELECT record_id, rank, label, round(1 - similarity_score, 6) AS distance, round(similarity_score, 6) AS similarity_score, 'semantic' AS search_type FROM {_near_sql(7, 15)}")
def _(spark, sf):
    found = search.vector_search(_vectors(spark, sf), _vector_of(spark, sf, 7), 15, key="record_id", keep=["label"])
    return rounded(found, 6, "distance", "similarity_score")


@query("filtered_vector_search", 128, 40, sql=f"SELECT record_id, rank, label, round(similarity_score, 6) AS similarity_score FROM {_near_sql(7, 10, '(e.label = 1 OR e.label >= 7)')}")
def _(spark, sf):
    where = {"$or": [{"label": {"$eq": 1}}, {"label": {"$gte": 7}}]}
    found = search.vector_search(_vectors(spark, sf), _vector_of(spark, sf, 7), key="record_id", keep=["label"], where=where)
    return rounded(found, 6, "similarity_score").select("record_id", "rank", "label", "similarity_score")


@query(
    "multi_vector_search", 129,
    sql="""WITH q AS (SELECT label, arg_min(embedding, vec_id)::DOUBLE[] AS v FROM embeddings GROUP BY label)
    SELECT q.label::VARCHAR AS query, vec_id AS record_id, CAST(row_number() OVER (PARTITION BY q.label ORDER BY list_cosine_similarity(e.embedding::DOUBLE[], v) DESC, vec_id) AS INTEGER) AS rank,
      round(list_cosine_similarity(e.embedding::DOUBLE[], v), 6) AS similarity_score FROM embeddings e, q QUALIFY rank <= 5""",
)
def _(spark, sf):
    vectors = _vectors(spark, sf)
    found = search.nearest(vectors, _first_per_label(vectors), 5, key="record_id")
    return rounded(found, 6, "similarity_score").select("query", "record_id", "rank", "similarity_score")


def _first_per_label(vectors) -> dict[str, list[float]]:
    """The first vector of each label."""
    first = vectors.groupBy("label").agg(F.min("record_id").alias("record_id"))
    firsts = vectors.join(first, ["label", "record_id"]).select("label", F.col("embedding").alias("v")).collect()
    return {str(r["label"]): list(r["v"]) for r in firsts}


@query(
    "similarity_matrix", 77,
    sql="""WITH q AS (SELECT label::VARCHAR AS anchor, arg_min(embedding, vec_id)::DOUBLE[] AS v FROM embeddings GROUP BY label)
    SELECT vec_id AS record_id, anchor, round(list_cosine_similarity(e.embedding::DOUBLE[], v), 6) AS cosine FROM embeddings e, q""",
)
def _(spark, sf):
    vectors = _vectors(spark, sf)
    return rounded(search.similarity_to(vectors, _first_per_label(vectors), "record_id"), 6, "cosine")


@query(
    "all_pairs_similarity", 77,
    sql="""SELECT a.vec_id AS record_id, b.vec_id AS neighbour, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine,
      CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) DESC, b.vec_id) AS INTEGER) AS rank
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id QUALIFY rank <= 5""",
)
def _(spark, sf):
    return rounded(neighbours.nearest_to_all(_vectors(spark, sf), 5, "record_id"), 6, "cosine")


_LOAD_SQL = "stored AS (SELECT 'record_' || doc_id AS id FROM documents WHERE lang = 'en'), incoming AS (SELECT 'record_' || doc_id AS id FROM documents WHERE source <> 'src3')"


def _index_sides(spark, sf):
    docs = articles(spark, sf)
    return search.metadata(docs.where("language = 'en'")), search.metadata(docs.where("source_name <> 'src3'"))


@query("rows_to_index", 130, sql=f"WITH {_LOAD_SQL} SELECT id FROM incoming WHERE id NOT IN (SELECT id FROM stored)")
def _(spark, sf):
    return search.rows_to_index(*_index_sides(spark, sf)).select("id")


@query(
    "index_load_counts", 130,
    sql=f"""WITH {_LOAD_SQL}, a AS (SELECT count(*) AS n FROM incoming WHERE id NOT IN (SELECT id FROM stored))
    SELECT a.n AS added, (SELECT count(*) FROM incoming) - a.n AS skipped, (SELECT count(*) FROM stored) + a.n AS total FROM a""",
)
def _(spark, sf):
    return search.load_counts(*_index_sides(spark, sf))


def _fused_sql(n: int | None) -> str:
    limit = f"ORDER BY rrf_score DESC, record_id LIMIT {n}" if n else ""
    return f"""SELECT coalesce(k.record_id, s.record_id) AS record_id, k.rank AS keyword_rank, s.rank AS semantic_rank,
      round_even(coalesce(1.0::DOUBLE / (60 + k.rank), 0) + coalesce(1.0::DOUBLE / (60 + s.rank), 0), 6) AS rrf_score
    FROM k FULL OUTER JOIN s ON k.record_id = s.record_id {limit}"""


@query("rank_fusion", 131, 46, sql=f"WITH {RATED_SQL}, k AS {_keyword_sql(_WORDS, 40)}, s AS {_near_sql(3, 40)} {_fused_sql(None)}")
def _(spark, sf):
    words = search.keyword_search(rated(spark, sf), _WORDS, n=40)
    near = search.vector_search(_vectors(spark, sf), _vector_of(spark, sf, 3), 40, key="record_id")
    return search.fuse(words, near).select("record_id", "keyword_rank", "semantic_rank", "rrf_score")


@query(
    "hybrid_search", 132,
    sql=f"WITH {RATED_SQL}, k AS {_keyword_sql(_WORDS, 30)}, s AS {_near_sql(3, 30)} SELECT *, 'hybrid' AS search_type FROM ({_fused_sql(10)})",
)
def _(spark, sf):
    found = search.hybrid_search(rated(spark, sf), _vectors(spark, sf), _WORDS, _vector_of(spark, sf, 3))
    return found.select("record_id", "keyword_rank", "semantic_rank", "rrf_score", "search_type")


@query(
    "compare_methods", 133,
    sql=f"""WITH {RATED_SQL}, k AS {_keyword_sql(_WORDS, 15)}, s AS {_near_sql(3, 15)}
    SELECT 'keyword' AS search_type, rank, record_id FROM k WHERE rank <= 5 UNION ALL SELECT 'semantic', rank, record_id FROM s WHERE rank <= 5
    UNION ALL SELECT 'hybrid', CAST(row_number() OVER (ORDER BY rrf_score DESC, record_id) AS INTEGER), record_id FROM ({_fused_sql(5)})""",
)
def _(spark, sf):
    from pyspark.sql import Window

    docs, vectors, vector = rated(spark, sf), _vectors(spark, sf), _vector_of(spark, sf, 3)
    fused = search.hybrid_search(docs, vectors, _WORDS, vector, 5)
    fused = fused.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("rrf_score"), "record_id")))
    return search.compare_methods(
        {"keyword": search.keyword_search(docs, _WORDS, n=5), "semantic": search.vector_search(vectors, vector, 5, key="record_id"), "hybrid": fused}
    )


@query(
    "synonym_overlap", 47,
    sql=f"""WITH {RATED_SQL}, a AS {_keyword_sql('thing with', 50)}, b AS {_keyword_sql('thing from', 50)},
    x AS {_near_sql(3, 50)}, y AS {_near_sql(4, 50)},
    o AS (SELECT 'keyword' AS method, (SELECT count(*) FROM a JOIN b USING (record_id)) AS overlap_count, (SELECT count(*) FROM a) AS set_a_size, (SELECT count(*) FROM b) AS set_b_size
      UNION ALL SELECT 'semantic', (SELECT count(*) FROM x JOIN y USING (record_id)), (SELECT count(*) FROM x), (SELECT count(*) FROM y))
    SELECT *, coalesce(round(overlap_count / nullif(least(set_a_size, set_b_size), 0), 6), 0) AS overlap_ratio FROM o""",
)
def _(spark, sf):
    docs, vectors = rated(spark, sf), _vectors(spark, sf)
    words = [search.keyword_search(docs, q, n=50) for q in ("thing with", "thing from")]
    near = [search.vector_search(vectors, _vector_of(spark, sf, v), 50, key="record_id") for v in (3, 4)]
    both = overlap(*words, "record_id", "record_id").withColumn("method", F.lit("keyword"))
    both = both.unionByName(overlap(*near, "record_id", "record_id").withColumn("method", F.lit("semantic")))
    return rounded(both, 6, "overlap_ratio")


@query("stored_vector_search", 128, 130, sql=f"SELECT record_id, rank, label, round(1 - similarity_score, 6) AS distance, round(similarity_score, 6) AS similarity_score, 'semantic' AS search_type FROM {_near_sql(7, 15)}")
def _(spark, sf):
    # Stored in two loads.
    path, vectors = scratch_path(spark, "vectors"), _vectors(spark, sf)
    cells.create(vectors.where("label % 2 = 0"), path)
    cells.append(vectors.where("label % 2 <> 0"), path)
    found = cells.search(spark, path, _vector_of(spark, sf, 7), 15, "record_id", keep=["label"])
    return rounded(found, 6, "distance", "similarity_score")


@query("indexed_keyword_search", 127, sql=f"WITH {RATED_SQL} SELECT *, 'keyword' AS search_type FROM {_keyword_sql('stupid schein licensed', 25)}")
def _(spark, sf):
    path = scratch_path(spark, "substrings")
    substrings.create(rated(spark, sf), path)
    return substrings.search(spark, path, "stupid Schein licensed", 25)
