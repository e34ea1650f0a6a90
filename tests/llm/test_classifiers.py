from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cairn.llm import language_id, quality_classifier, quality_rules
from cairn.llm.training import rule_statistics

SF = "/root/testdata/sf0.01"
ODD = [None, "", " \n\t", "!!!", "123", "x" * 50_000, "ä", "日本語"]


def statistics(text):
    """The five rule statistics, by their definition."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    again = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    hit = {k + d for k in range(len(w) - 2) if again[tuple(w[k : k + 3])] > 1 for d in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:k] for k, x in enumerate(lines)), len(hit))


def test_rule_statistics(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + [*ODD, "a b c a b c a", "x x x x", "a\x0bb\x85c\x1cd", "l\nl\n \n \nl"]
    for t in texts:
        assert rule_statistics(t)[:5] == statistics(t)


def test_quality_rules(spark, documents):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    forest = quality_rules.fit(docs, labels)
    rows = {r.doc_id: r for r in quality_rules.assess(docs, forest).collect()}
    marked = {r.doc_id: r.quality for r in labels.collect()}
    free = [i for i in marked if not rows[i].base_failed]
    good, bad = ([rows[i].kept for i in free if marked[i] == q] for q in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.2
    odd = {r.doc_id: r for r in quality_rules.assess(documents(ODD), forest).collect()}
    assert len(odd) == len(ODD) and all(r.base_failed and not r.kept for r in odd.values())
    assert quality_rules.fit(docs, labels.limit(0)) is None
    assert quality_rules.assess(documents(ODD).limit(0), None).count() == 0


def test_paths_are_shorter_for_what_stands_apart():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (500, 3)), [[9, 9, 9]]])
    scores = quality_rules.grow(x).score(x)
    assert scores.argmax() == 500


def test_quality_classifier(spark, documents):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.op6_quality_classifier(spark, SF).join(labels, "doc_id").where("held_out")
    wrong = got.where(F.col("predicted") != F.col("quality")).count()
    assert wrong <= 0.03 * got.count()
    model = quality_classifier.fit(docs, labels, where=quality_classifier.training_rows())
    rows = quality_classifier.score(documents(ODD), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert quality_classifier.fit(docs, labels.limit(0)).score(np.zeros((1, 16)))[0] == 0.5
    kept = quality_classifier.keep_good(docs, model)
    assert kept.schema == docs.schema and 0.8 < kept.count() / docs.count() < 0.95


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (3000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality_classifier.train(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.9


def test_language_id(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.op1_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() >= 0.98 * got.count()
    model = language_id.fit(docs)
    assert len(model.owner) > len(model.languages)  # several centroids for a language
    rows = {r.doc_id: r for r in language_id.predict(documents(ODD), model).collect()}
    assert [rows[i].lang_pred for i in range(5)] == ["und"] * 5
    assert all(rows[i].lang_pred in model.languages for i in (5, 6, 7))
    assert rows[7].rejected
    none = language_id.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language_id.predict(documents(["some text"]), none).collect()} == {"und"}


def test_long_texts_count_piece_by_piece():
    text = "abc déf " * 200_000
    whole = language_id.counts(text)
    assert whole.sum() > 0 and abs(int(whole.sum()) - 3 * (len(text.encode()) - 1)) < 20
