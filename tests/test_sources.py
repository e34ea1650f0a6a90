from __future__ import annotations

import json

from pyspark.sql import functions as F

from cairn.functions.text import shard
from cairn.operators import index
from cairn.sources import files, pages
from cairn.sources.records import first_of_each, with_ordinal
from cairn.streaming import pages as streams


def frame(spark, payload):
    return spark.createDataFrame([("p1", json.dumps(payload))], "page string, json string").select("page", F.parse_json("json").alias("payload"))


def test_catalogue_page(spark):
    item = {"id": "a", "title": " T ", "description": "d", "license": "OGL", "keywords": "x; y,x", "links": {"self": {"href": "https://h/a"}}, "internal_note": "no"}
    secret = {"id": "b", "title": "B", "links": {"self": {"href": "https://h/b?token=1"}}}
    got = pages.catalogue(frame(spark, {"results": [item, {"id": "c"}, secret]})).orderBy("id").collect()
    assert [(r.id, r.title, r.url, r.keywords) for r in got] == [("a", "T", "https://h/a", ["x", "y"]), ("b", "B", None, [])]
    assert "internal_note" not in got[0].asDict()
    assert pages.raw_counts(frame(spark, {"results": [item, {"id": "c"}, secret]}), "$.items", "$.results").first().seen == 3


def test_key_family_page_takes_objects_for_lists(spark):
    family = {
        "id": "NM_1", "name": {"value": "Name"}, "annotations": {"annotation": {"annotationtitle": "Keywords", "annotationtext": "b,a"}},
        "components": {"dimension": [{"conceptref": "GEO"}, {"conceptref": "AGE"}]},
    }
    got = pages.key_families(frame(spark, {"structure": {"keyfamilies": {"keyfamily": family}}})).first()
    assert (got.id, got.title, got.keywords, got.dimensions) == ("NM_1", "Name", ["a", "b"], ["GEO", "AGE"])


def test_feature_page_drops_geometry(spark):
    feature = {"id": "f", "geometry": {"x": 1}, "properties": {"title": "F", "modified": 1700000000000, "tags": ["q", "q"], "url": "http://h/f"}}
    got = pages.features(frame(spark, {"features": [feature]})).first()
    assert (got.id, got.modified, got.keywords) == ("f", "2023-11-14T22:13:20Z", ["q"])
    assert "geometry" not in got.asDict()


def test_first_page_wins(spark):
    rows = frame(spark, {"items": [{"id": "a", "title": "one"}]})
    again = frame(spark, {"items": [{"id": "a", "title": "two"}]}).withColumn("page", F.lit("p0"))
    got = pages.first_by_id(pages.catalogue(rows.unionAll(again))).collect()
    assert [(r.page, r.title) for r in got] == [("p0", "two")]


def test_ordinals_are_dense(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(5)
    got = with_ordinal(rows, F.col("k")).orderBy("ordinal").collect()
    assert [(r.k, r.ordinal) for r in got] == [(k, k) for k in range(1000)]
    assert with_ordinal(rows.limit(0), F.col("k")).count() == 0


def test_first_of_each_skips_blank_keys(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("", 0, "z"), (None, 0, "z")], "k string, o int, v string")
    assert [tuple(r) for r in first_of_each(rows, "k", "o").collect()] == [("a", 1, "y")]


def test_manifest_events_front_matter_and_checksums(spark, tmp_path):
    (tmp_path / "m.csv").write_text("slug,topic,subTopic,dataset,code,include\na,t,s,d,c,true\nb,t,s,d,c,false\n")
    assert [r.include for r in files.read_manifest(spark, str(tmp_path / "m.csv")).orderBy("slug").collect()] == [True, False]
    (tmp_path / "good.jsonl").write_text('{"seq": 1, "event": "x"}\n{"seq": 2, "event": "y"}\n')
    (tmp_path / "bad.jsonl").write_text('{"seq": 1, "event": "x"}\n{"seq": 3, "event": "y"}\n')
    broken = files.broken_sequences(files.read_events(spark, str(tmp_path / "*.jsonl"))).collect()
    assert [r.file.rsplit("/", 1)[1] for r in broken] == ["bad.jsonl"]
    made = files.render_front_matter(spark.createDataFrame([("p", "T", 3)], "path string, title string, n int"), "path", {"title": F.col("title"), "n": F.col("n")}, F.lit("body\n")).first()
    assert made.text == '---\ntitle: "T"\nn: 3\n---\nbody\n'
    (tmp_path / "c.md").write_text(made.text)
    got = {r.key: r.value.toPython() for r in files.read_front_matter(spark, str(tmp_path / "c.md")).collect()}
    assert got == {"title": "T", "n": 3}
    sums = files.checksums(spark, str(tmp_path))
    assert sums.count() == 4 and files.differing(sums, sums).count() == 0


def test_sinks(spark, tmp_path):
    rows = spark.range(1200).select(F.col("id").alias("ordinal"), F.col("id").cast("string").alias("x"))
    files.write_chunks(rows, str(tmp_path / "chunks"))
    assert sorted(p.name for p in (tmp_path / "chunks").glob("chunk=*")) == ["chunk=0", "chunk=1", "chunk=2"]
    tokens = spark.createDataFrame([("alpha", 1), ("beta", 2)], "token string, ordinal long")
    files.write_index(tokens, str(tmp_path / "index"), shard(F.col("token")))
    assert spark.read.parquet(str(tmp_path / "index")).where("shard = 'al'").count() == 1


def test_stream_resumes_and_finds_gaps(spark, tmp_path):
    source, table, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"items": [{"id": "a", "title": "A"}]}')
    for _ in range(2):
        streams.ingest(pages.catalogue(streams.page_stream(spark, source)), table, state)
    (tmp_path / "in/2.json").write_text('{"items": [{"id": "b", "title": "B"}]}')
    streams.ingest(pages.catalogue(streams.page_stream(spark, source)), table, state)
    assert sorted(r.id for r in spark.read.parquet(table).collect()) == ["a", "b"]
    spark.createDataFrame([("x", 0), ("x", 1), ("x", 3), ("y", 0)], "g string, n long").write.parquet(str(tmp_path / "ev"))
    events = spark.readStream.schema("g string, n long").parquet(str(tmp_path / "ev"))
    streams.ingest(streams.sequence_gaps(events, "g", "n"), str(tmp_path / "gaps"), str(tmp_path / "gapstate"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "gaps")).collect()] == [("x", 2, 3)]


def test_query_tokens_equal_the_column_tokenizer(spark):
    from cairn.functions.text import fold_any, search_tokens

    texts = ["NM_66_1 data for the UK", "Population.population -- population", "Café"]
    frame_ = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame_.select(search_tokens(F.col("t"))).collect()]
    assert got == [["nm_66_1", "data", "uk"], ["population.population", "population"], ["cafe"]] == [index.query_tokens(t) for t in texts]
    assert [r[0] for r in frame_.select(fold_any("t")).collect()][2] == "cafe"
