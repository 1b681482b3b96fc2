import datetime as dt
import json

from pyspark.sql import functions as F

from newsmill.operators import ingest
from newsmill.plans.normalise import normalise
from newsmill.sources import files, stores


def test_article_pages_one_per_file(spark, tmp_path):
    page = {"status": "ok", "totalResults": 2, "articles": [
        {"source": {"id": None, "name": "S"}, "author": "A", "title": "T", "description": "D", "url": "u", "urlToImage": "i", "publishedAt": "2026-01-01T00:00:00Z", "content": "C"},
        {"title": "U"},
    ]}
    (tmp_path / "page_1.json").write_text(json.dumps(page, indent=4))
    (tmp_path / "page_2.json").write_text("{ not json")
    found = {r["title"]: r for r in files.read_article_pages(spark, str(tmp_path)).collect()}
    assert set(found) == {"T", "U"}
    assert (found["T"]["source"], found["T"]["file_name"], found["T"]["document_type"], found["U"]["source"]) == ("S", "page_1.json", "json", None)
    assert files.read_article_fields(spark, str(tmp_path)).where("content = 'C'").count() == 1


def test_xml_rows(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<articles><article><id>1</id><title>T</title></article><article><id>2</id><title>U</title><category>c</category></article></articles>")
    found = sorted((r["id"], r["title"], r["category"], r["file_name"]) for r in files.read_xml_rows(spark, str(tmp_path)).collect())
    assert found == [("1", "T", None, "a.xml"), ("2", "U", "c", "a.xml")]


def test_csv_tokens_and_bad_dates(spark, tmp_path):
    lines = ["record_id,title,published_date,score", '1,"a, ""b""\nc",2026-01-02,1.5', "x,N/A,never,null", "3,,2026-01-03T04:05:06,NaN", "4,nan,None,n/a"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    types = {"record_id": "bigint", "title": "string", "published_date": "timestamp", "score": "double"}
    rows = [tuple(r) for r in files.read_csv(spark, str(tmp_path), types, multi_line=True).collect()]
    assert rows == [
        (1, 'a, "b"\nc', dt.datetime(2026, 1, 2), 1.5), (None, None, None, None), (3, None, dt.datetime(2026, 1, 3, 4, 5, 6), None), (4, None, None, None),
    ]


def test_texts_and_bytes(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("hé\nx".encode("cp1252"))
    (tmp_path / "b.txt").write_bytes("hé\nx".encode())
    assert {r["file_name"]: r["text"] for r in files.read_decoded(spark, str(tmp_path)).collect()} == {"a.txt": "hé\nx", "b.txt": "hé\nx"}
    assert files.read_whole_texts(spark, str(tmp_path / "b.txt")).first()["text"] == "hé\nx"


def test_bad_json_is_marked(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\n{"id": \n')
    assert sorted((r["id"] or 0, r["is_bad"]) for r in files.read_json_objects(spark, str(tmp_path), "id INT").collect()) == [(0, True), (1, False)]


def test_fallback_on_missing_and_empty(spark, tmp_path):
    good = spark.createDataFrame([(1,)], "v int")
    assert files.with_fallback(lambda: spark.read.parquet(str(tmp_path / "none")), lambda: good).count() == 1
    assert files.with_fallback(lambda: good.where("v > 5"), lambda: good).count() == 1
    assert files.with_fallback(lambda: good.where("v = 1"), lambda: good.limit(0)).count() == 1


def test_results_and_export(spark, tmp_path):
    df = spark.createDataFrame([("f", 2, "b"), ("f", 1, "a"), ("g", 1, "c")], "file string, n int, line string")
    paths = stores.write_results({"one": df, "two": df.groupBy("file").count()}, str(tmp_path))
    assert set(paths) == {"one", "two"} and spark.read.csv(paths["one"], header=True).count() == 3
    stores.export_lines(df, str(tmp_path / "txt"), "file", ["n"], F.col("line"))
    parts = sorted((tmp_path / "txt" / "file=f").glob("part-*"))
    assert "".join(p.read_text() for p in parts) == "a\nb\n"


def test_exported_folders_are_listed_by_few_tasks(spark, tmp_path):
    most = 4 * spark.sparkContext.defaultParallelism
    folders = max(most, 32) + 8
    path, listing = str(tmp_path / "txt"), "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    df = spark.range(folders).select(F.col("id").alias("file"), F.lit(0).alias("n"), F.col("id").cast("string").alias("line"))
    stores.export_lines(df, path, "file", ["n"], F.col("line"))
    before = spark.conf.get(listing)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        lines = stores.exported_lines(spark, path)
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(name, None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert [tracker.getStageInfo(s).numTasks for s in stages] == [most] and spark.conf.get(listing) == before
    assert sorted((r.file, r.value) for r in lines.collect()) == [(i, str(i)) for i in range(folders)]


def test_table_reset_and_fixed_schema(spark, tmp_path):
    rows = spark.createDataFrame([(1, "T", 2.0)], "record_id int, title string, rating_score double")
    full = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in stores.METRICS_SCHEMA if f.name not in rows.columns])
    for _ in range(2):
        out = stores.load_table(full, "metrics_test", str(tmp_path / "m"))
        assert out.count() == 1 and dict(out.dtypes)["rating_score"] == "float"
    assert spark.table("metrics_test").count() == 1
    stores.create_table(spark, "metrics_test", str(tmp_path / "m"))


def test_upsert_to_a_new_path(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(str(tmp_path / "v1"))
    old = spark.read.parquet(str(tmp_path / "v1"))
    new = spark.createDataFrame([(2, "c")], "k int, v string")
    assert sorted(tuple(r) for r in stores.upsert_to(old, new, "k", str(tmp_path / "v2")).collect()) == [(1, "a"), (2, "c")]
    assert [tuple(r) for r in stores.upsert_to(old, new, "k", str(tmp_path / "v3"), clear=True).collect()] == [(2, "c")]


def test_flatten_prefers_the_payload(spark):
    df = spark.createDataFrame(
        [(("T", "web", None), "path", 1, "env", "f.json"), ((None, None, "pdf"), "path2", 1, "env", None)],
        "data struct<title:string,source:string,type:string>, source string, version int, type string, file_name string",
    )
    found = [r.asDict() for r in ingest.flatten_envelopes(df).collect()]
    assert found[0] == {"title": "T", "source_name": "web", "source_path": "path", "version": 1, "file_name": "f.json", "type": "env"}
    assert found[1]["type"] == "pdf"
    texts = spark.createDataFrame([("body", "s"), (None, "t")], "data string, source string")
    assert [tuple(r) for r in ingest.flatten_envelopes(texts).collect()] == [("body", "s"), ("", "t")]


def test_variant_payloads_of_other_shapes(spark):
    df = spark.createDataFrame([('{"k": 1, "source": {"id": "i", "name": "n"}}',), ('{"k": "x", "source": "plain"}',), ("7",)], "j string")
    found = [tuple(r) for r in ingest.flatten_variant(df.select(F.parse_json("j").alias("data")), {"k": "int"}).collect()]
    assert found == [(1, "i", "n"), (None, None, "plain"), (None, None, None)]


def test_team_rows(spark):
    html = '<table><tr class="x team"><td class="name"> Bruins </td><td class="year">1990</td><td class="wins"><b>44</b></td></tr><tr class="steam"><td class="name">no</td></tr></table>'
    df = spark.createDataFrame([(html,), (None,), ("<p>",)], "html string")
    found = [tuple(r) for r in ingest.html_rows(df, "html", ingest.TEAM_ROW, ingest.TEAM_CELLS).collect()]
    assert found == [(0, "Bruins", "1990", "44", "")]


def test_segments_move_with_their_words(spark):
    chunks = spark.createDataFrame([("f", 0, 300.0, "en"), ("f", 1, 300.0, "de"), ("f", 2, 12.5, "de"), ("g", 0, 9.0, "fr")], "source_file string, chunk int, duration_s double, language string")
    segments = spark.createDataFrame([("f", 2, 1.0, 2.0, [("w", 1.25, 1.5)]), ("f", 0, 0.5, 1.0, None), ("g", 0, 0.0, 3.0, [])], "source_file string, chunk int, start double, end double, words array<struct<word:string,start:double,end:double>>")
    found = {(r["source_file"], r["chunk"]): r for r in ingest.shift_segments(segments, chunks, width=2).collect()}
    assert (found["f", 2]["start"], found["f", 2]["words"][0]["end"], found["f", 0]["start"], found["g", 0]["end"]) == (601.0, 601.5, 0.5, 3.0)
    summary = {r["source_file"]: r for r in ingest.recording_summary(chunks.withColumn("language_probability", F.lit(0.9))).collect()}
    assert (summary["f"]["language"], summary["f"]["total_chunks"], summary["f"]["duration_s"]) == ("en", 3, 612.5)


def test_key_values_last_wins(spark):
    df = spark.createDataFrame([("s", "a", 1, 1), ("s", "a", 2, 2), ("s", "b", 3, 3), ("s", None, 4, 4)], "sheet string, k string, v int, n int")
    assert [tuple(r) for r in ingest.key_values(df, "sheet", "k", "v", "n", ["a", "b", "c"]).collect()] == [("s", 2, 3, None)]


def test_normalise_a_bare_record(spark):
    df = spark.createDataFrame([("T", "x.json", None, 3, "  "), (" ", None, "http://u", None, None)], "title string, file_name string, url string, mentions int, content string")
    a, b = normalise(df).collect()
    assert (a["document_type"], a["category"], a["content_text"], a["popularity"]) == ("json", "json", "T", 3.0)
    assert (b["document_type"], b["title"], b["content_text"], b["vote_count"]) == ("news_api", "Untitled record", "Untitled record", 1.0)
    assert a["record_id"] != b["record_id"]


def test_normalise_keeps_a_known_text(spark):
    df = spark.createDataFrame([(1, "T", "body", "en")], "record_id int, title string, content_text string, original_language string")
    row = normalise(df).first()
    assert (row["content_text"], row["language"], row["rating_score"]) == ("body", "en", pytest_approx(0.04))


def pytest_approx(v):
    import pytest

    return pytest.approx(v)
