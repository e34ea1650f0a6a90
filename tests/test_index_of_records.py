"""The index is made from the records' own rows: fields meet without a shuffle, and only records whose ids are repeated are grouped."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from cairn.operators import index
from cairn.sources import files
from cairn.sources.records import COLUMNS, corpus_of, distinct_records


def made(spark, rows):
    own = spark.createDataFrame(rows, "id string, title string, notes string, topics array<string>, publisher_title string")
    empty = {c: F.array().cast(k) if k.startswith("array") else F.lit(None).cast(k) for c, k in COLUMNS.items()}
    return own.select(*(F.col(c) if c in own.columns else empty[c].alias(c) for c in COLUMNS))


ROWS = [("a:1", "Red fox", "A red fox and a dog. dog", ["dog"], "Red"), ("a:2", None, None, ["the", "ß"], None), ("a:3", "x.y-z é", "E-mail x.y-z fox", [], "fox"), ("", "blank", "id", [], None)]


def test_postings_equal_fields_added_up(spark):
    corpus = corpus_of(made(spark, ROWS + ROWS[:2]))
    want = {}
    for row in corpus.select("ordinal", *(index.search_tokens(F.coalesce(c, F.lit(""))).alias(f) for f, c in index.search_fields().items())).collect():
        for f in index.search_fields():
            for token in row[f]:
                score, mask = want.get((token, row["ordinal"]), (0, 0))
                want[token, row["ordinal"]] = score + index.WEIGHTS[f], mask | index.MASKS[f]
    rows = index.postings(corpus)
    assert {(r["token"], r["ordinal"]): (r["score"], r["mask"]) for r in rows.collect()} == want and rows.count() == len(want)
    counts = {r["token"]: r["df"] for r in index.lexicon(index.tokens_of_records(corpus)).collect()}
    assert counts == {t: sum(k == t for k, _ in want) for t, _ in want}


def exchanges(df):
    return re.findall(r"\b(?:Aggregate|Repartition\w*) ", df._jdf.queryExecution().optimizedPlan().toString())


def test_records_are_not_shuffled_for_the_index(spark):
    own = made(spark, ROWS)
    assert not exchanges(index.postings(own.withColumn("ordinal", F.col("id")))) and not exchanges(index.tokens_of_records(distinct_records(own)))


def test_long_texts_stay_out_of_narrow_queries(spark, tmp_path):
    made(spark, ROWS).write.parquet(str(tmp_path / "records"))
    narrow = corpus_of(spark.read.parquet(str(tmp_path / "records"))).select("ordinal", "id")
    assert "notes#" not in narrow._jdf.queryExecution().executedPlan().toString()


def test_of_repeated_records_the_first_counts(spark):
    own = made(spark, ROWS + [("a:1", "Aardvark", "ant", [], None), ("a:1", None, "bee", [], None)])
    assert {r["id"]: r["title"] for r in distinct_records(own).collect()} == {"a:1": None, "a:2": None, "a:3": "x.y-z é"}
    assert {r["token"]: r["df"] for r in index.lexicon(index.tokens_of_records(distinct_records(own))).where("token IN ('bee', 'ant', 'fox')").collect()} == {"bee": 1, "fox": 1}


def test_an_index_has_the_tables_that_are_named(spark, tmp_path):
    files.write_search_index(corpus_of(made(spark, ROWS)), str(tmp_path / "one"), ("documents",))
    files.write_search_index(corpus_of(made(spark, ROWS)), str(tmp_path / "all"))
    assert [p.name for p in (tmp_path / "one").iterdir()] == ["documents"] and sorted(p.name for p in (tmp_path / "all").iterdir()) == sorted(files.TABLES)


def test_a_lexicon_alone_needs_no_ordinals(spark, monkeypatch):
    """counts by token don't wait for the corpus to be numbered."""
    from cairn.plans import sources

    monkeypatch.setattr(sources, "corpus", lambda *_: (_ for _ in ()).throw(AssertionError("numbered")))
    assert sources.index_shards(spark, "/root/testdata/sf0.001").count() > 0

