"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for operators and stages whose own tests lack them."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cairn.llm import bpe, decontamination, language_id, line_dedup, ngram_join, quality_classifier, quality_rules
from cairn.llm import substring_dedup as s
from cairn.llm.common import materialize
from cairn.llm.training import labelled_sample

SF = "/root/testdata/sf0.01"
CLASHING = ("id", "key", "starts", "kept", "first", "bits", "t", "words", "hits", "own", "text_key", "removed", "score", "predicted", "rejected", "label", "x", "n_words", "copies", "met_by")


@pytest.fixture
def odd(documents, prose):
    """Documents with null, empty and repeated rows and ids, and columns called like those that operators make on the way."""
    long = " ".join(prose(70_000, 1))
    texts = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "no id"), (None, None), (4, long), (5, "a\nb\nc\nd"), (6, "a\nb\nc"), (7, "The quick brown fox jumps. " * 20)]
    return documents(texts).select("*", *(F.lit("clash").alias(c) for c in CLASHING)), texts


def key(r):
    return (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")


@pytest.fixture(scope="module")
def learnt(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return language_id.fit(docs), quality_classifier.fit(docs, labels), quality_rules.fit(docs, labels)


def test_classifiers(odd, learnt):
    docs, texts = odd
    centroids, additive, forest = learnt
    for got, columns in (
        (language_id.predict(docs, centroids), ["doc_id", "lang_pred", "score", "rejected"]), (quality_classifier.score(docs, additive), ["doc_id", "score", "predicted"]), (quality_rules.assess(docs, forest), None),
    ):
        assert columns is None or got.columns == columns
        rows = got.collect()
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((i is None, i or 0) for i, _ in texts)
        assert len({tuple(r) for r in rows if r.doc_id == 3}) == 1
        assert got.where("false").count() == 0
    assert quality_classifier.keep_good(docs, additive, 0.0).columns == docs.columns


def test_language_against_plain_loops(documents, learnt):
    model = learnt[0]
    texts = ["Éai les, oution. Èle ouchan", "the of andthe in", "Ünd der die", "x", "ab cd " * 300]

    def gram_counts(text):
        out = np.zeros(language_id.DIMENSIONS)
        raw = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in text.lower().encode())
        raw = bytes(b for k, b in enumerate(raw) if k == 0 or b != 0x20 or raw[k - 1] != 0x20)
        for n in (1, 2, 3):
            for k in range(len(raw) - n + 1):
                g = sum(b * f for b, f in zip(raw[k : k + n], {1: (1,), 2: (0x101, 1), 3: (0x10101, 0x101, 1)}[n], strict=True))
                out[((g + n) * 2654435761 % 2**32) >> 20] += 1
        return out

    rows = {r.doc_id: r for r in language_id.predict(documents(texts), model).collect()}
    for i, t in enumerate(texts):
        v = np.log1p(gram_counts(t)) * model.idf
        cosines = model.vectors @ (v / np.linalg.norm(v))
        assert rows[i].lang_pred == model.languages[model.owner[cosines.argmax()]]
        assert rows[i].score == pytest.approx(cosines.max(), abs=1e-5)


def test_ties_between_languages():
    tf = np.array([[1.0] * 8 + [0.0] * (language_id.DIMENSIONS - 8)] * 4)
    model = language_id.train(tf, ["b", "a", "b", "a"])
    assert model.languages[model.owner[model.nearest(tf)[0][0]]] == "a"


def test_sample_of_languages(spark):
    """One very common text doesn't crowd others out, and four-byte characters don't overflow the counts."""
    wide = "\U00010348" * 59_999
    rows = [("xx", "common")] * 3000 + [("xx", f"rare {k}") for k in range(50)] + [("yy", wide), ("yy", None)]
    docs = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string").repartition(4)
    model = language_id.fit(docs, max_rows=2000)
    assert model.languages == ["xx", "yy"]
    assert np.array_equal(language_id.unpacked(language_id.packed(language_id.counts(wide))), language_id.counts(wide))
    got = {r.text: r.lang_pred for r in language_id.predict(docs.withColumn("doc_id", F.col("text")), model).select(F.col("doc_id").alias("text"), "lang_pred").distinct().collect()}
    assert got["rare 7"] == "xx" and got[wide] == "yy" and got[None] == "und"


def test_a_language_of_copies_is_learnt(spark):
    """20,000 rows of two texts beside ordinary ones, and more languages than texts are asked for."""
    copies = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, "zażółć gęślą jaźń").otherwise("pchnąć w tę łódź jeża").alias("text"), F.lit("pl").alias("lang"))
    english = spark.createDataFrame([(f"the {k} quick brown foxes jump over {k * 7} lazy dogs", "en") for k in range(3000)], "text string, lang string")
    model = language_id.fit(copies.unionAll(english).repartition(5), max_rows=400)
    assert model.languages == ["en", "pl"]
    got = language_id.predict(copies.limit(2).withColumn("doc_id", F.lit(1)), model).select("lang_pred").distinct().collect()
    assert [r[0] for r in got] == ["pl"]
    many = spark.createDataFrame([(f"{chr(0x4E00 + k)} {k}", f"l{k:02d}") for k in range(30)], "text string, lang string")
    assert len(language_id.fit(many, max_rows=10).languages) == 30


def test_sample_of_labels_has_one_text_for_each_id(spark):
    docs = spark.createDataFrame([(k % 10, f"text {k}") for k in range(500)] + [(3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(10)] + [(0, 1), (None, 1), (4, None)], "doc_id long, quality int")
    rows = sorted((r.doc_id, r.text, r.label) for r in labelled_sample(docs, labels, "quality", 100).collect())
    assert rows == [(k, min(f"text {j}" for j in range(500) if j % 10 == k), k % 2) for k in range(10)]
    assert labelled_sample(docs, labels, "quality", 4).count() == 4


def test_classifier_against_plain_lookups(documents, learnt):
    model = learnt[1]
    texts = ["some text here, with words. " * 9, "BUY NOW!!! $$$ " * 30, "", "word " * 500]
    rows = {r.doc_id: r.score for r in quality_classifier.score(documents(texts), model).collect()}
    for i, t in enumerate(texts):
        x = quality_classifier.matrix([quality_classifier.features(t)])[0]
        margin = model.base + sum(table[sum(c <= x[f] for c in model.cuts[f])] for f, table in enumerate(model.tables))
        place = lambda f: sum(c <= x[f] for c in model.coarse[f])
        margin += sum(table[place(a), place(b)] for (a, b), table in zip(model.pairs, model.pair_tables, strict=True))
        assert rows[i] == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-9)


def test_forest_against_plain_paths(spark, learnt):
    forest = learnt[2]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = quality_rules.assess(docs, forest).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in rows:
        words_ = [w for w in texts[r.doc_id].replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
        chars = sum(map(len, words_))
        capitals = sum("A" <= c <= "Z" for c in texts[r.doc_id])
        x = (chars / max(len(words_), 1), sum(c in "#*$%&|<>" for c in texts[r.doc_id]) / max(chars, 1), capitals / max(chars, 1))
        failed = len(words_) < 50 or r.n_repeat_words / max(len(words_), 1) > 0.5
        assert r.base_failed == failed
        total = 0.0
        for feature, split, depth in zip(forest.feature, forest.split, forest.depth, strict=True):
            node = 0
            while feature[node] >= 0:
                node = 2 * node + 1 + int(x[feature[node]] >= split[node])
            total += depth[node]
        score = 2.0 ** (-total / len(forest.feature) / forest.norm)
        assert r.anomaly_score == pytest.approx(score, abs=1e-9)
        assert r.kept == (not failed and score < forest.threshold)


def test_decontamination(odd, spark, prose):
    docs, texts = odd
    items = spark.createDataFrame([("i", " ".join(prose(70_000, 1)[500:520])), (None, "x")], "item_id string, text string")
    index = decontamination.indexed(docs)
    rows = decontamination.phrase_matches(index, items).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, len(r.spans)) for r in rows) == sorted((i is None, i or 0, int(i == 4)) for i, _ in texts)
    got = decontamination.clean(docs, items)
    assert got.columns == docs.columns
    assert sorted(map(key, ((r.doc_id, r.text) for r in got.collect()))) == sorted(key(p) for p in texts if p[0] != 4)
    assert decontamination.clean(docs.where("false"), items).count() == 0
    assert decontamination.clean(docs, items.where("false")).count() == len(texts)


def test_lines_and_near_copies(odd):
    docs, texts = odd
    rows = line_dedup.dedup_lines(docs, dropped="N_words")
    assert rows.columns == [c for c in docs.columns if c != "n_words"] + ["N_words"]
    assert sorted(map(key, ((r.doc_id, r.text) for r in rows.collect()))) == sorted(key((i, "" if i == 6 else t)) for i, t in texts)
    assert line_dedup.drop_repeated_lines(docs).columns == docs.columns
    one = ngram_join.one_of_each(docs)
    assert one.columns == docs.columns
    assert sorted(map(key, ((r.doc_id, r.text) for r in one.collect()))) == sorted(map(key, set(texts)))
    assert ngram_join.one_of_each(docs.where("false")).count() == 0


def test_buckets_over_the_size_are_split(spark, documents, prose):
    """Texts that share one phrase and little else leave their common bucket at a deeper level."""
    phrase = prose(9, 1)
    texts = [" ".join(phrase + prose(4, 100 + k)) for k in range(400)]
    own = documents(texts).select(F.col("doc_id").alias("id"), F.sha2("text", 256).cast("binary").alias("key"), "text")
    sketch = materialize(ngram_join.sketches(own, 0.8, 6, 5), "sketch")
    sizes = [r["size"] for r in ngram_join.leaves(sketch).select("bucket", "size").distinct().collect()]
    first = F.explode(F.filter("chosen", lambda c: F.pmod(ngram_join.code_of(c), F.lit(ngram_join.LEVELS)) == 0)).alias("c")
    large = sketch.select(first).groupBy("c").count().where(F.col("count") > ngram_join.SMALL_BUCKET).count()
    assert large > 0
    closed_at_once = sum(1 for n in sizes if n > ngram_join.SMALL_BUCKET)
    assert len(sizes) > closed_at_once  # deeper buckets exist beside those that stay together


def test_tokens(odd):
    docs, texts = odd
    own = docs.withColumns({"token_ids": F.lit("clash"), "n_tokens": F.lit("clash")})
    got = corpus_pipeline.tokens(own.sparkSession, own, SF)
    rows = got.collect()
    assert len(rows) == len(texts) and all(r.n_tokens == len(r.token_ids) for r in rows)
    assert bpe.encode(docs.where("false")).count() == 0


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_on_odd_and_empty_tables(stage, odd, spark):
    docs, _ = odd
    got = stage[1](spark, docs, SF)
    assert got.columns == docs.columns
    assert got.count() <= docs.count()
    assert stage[1](spark, docs.where("false"), SF).count() == 0


def near_passages(prose, rng, n, length):
    """Pairs of passages of some length, one word of the second changed, left out or put in."""
    for k in range(n):
        own = prose(length, 50_000 + 100 * length + k)
        at, kind = rng.randrange(length), rng.randrange(3)
        other = [*own[:at], "changed", *own[at + 1 :]] if kind == 0 else [*own[:at], *own[at + 1 :]] if kind == 1 else [*own[:at], "more", *own[at:]]
        yield own, other


def similar(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("length", [50, 60])
def test_recall_of_near_passages(documents, prose, length):
    """Brute force: a pair counts if some run of 50 words of one text and some of the other reach the similarity. Of these pairs 95 in a hundred at least are found."""
    import random

    rng = random.Random(length)
    texts, pairs = [], list(near_passages(prose, rng, 150, length))
    for k, (own, other) in enumerate(pairs):
        texts += [" ".join(prose(25, 60_000 + k) + own + prose(25, 70_000 + k)), " ".join(prose(25, 80_000 + k) + other + prose(25, 90_000 + k))]
    rows = {r.doc_id: r for r in s.find_repeats(documents(texts)).collect()}
    real = found = 0
    for k in range(len(pairs)):
        v, w = texts[2 * k].split(), texts[2 * k + 1].split()
        if any(similar(v[i : i + 50], w[j : j + 50]) >= 0.8 for i in range(15, len(v) - 64) for j in range(max(0, i - 12), min(len(w) - 49, i + 13))):
            real += 1
            found += bool(rows[2 * k].shared) and bool(rows[2 * k + 1].shared)
        else:
            assert not rows[2 * k].shared and not rows[2 * k + 1].shared
    print(f"passages of {length} words: {found} of {real} met")
    assert real > 100 and found >= 0.95 * real


def test_long_texts_and_segments(documents, prose):
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 2**63, 3000).astype(np.uint64)
    whole, parts = (s.signatures(tokens, 46, segment) for segment in (1 << 22, 500))
    assert {(a, b // 46**2) for a, b in zip(*(v.tolist() for v in whole), strict=True)} == {(a, b // 46**2) for a, b in zip(*(v.tolist() for v in parts), strict=True)}
    passage = prose(60, 2)
    texts = [" ".join(prose(70_000, 3) + passage + prose(30, 4)), " ".join(passage + prose(40, 5)), " ".join(passage + ["x"] + prose(80, 6) + passage), " ".join(["word"] * 400)]
    rows = {r.doc_id: r for r in s.find_repeats(documents(texts)).collect()}
    assert any(x["from"] <= 70_000 and x["to"] >= 70_060 for x in rows[0].shared)
    assert rows[1].shared and len(rows[2].shared) == 2
    assert sum(x["to"] - x["from"] for x in rows[3].repeats) >= 300  # its first fifty words stay
    assert sum(x["to"] - x["from"] for x in rows[3].repeats) <= 350


def test_copies_without_ids_and_with_equal_ids(documents, prose):
    a, b, c = (" ".join(prose(60, k)) for k in (1, 2, 3))
    docs = documents([(1, a), (1, a), (2, a), (None, a), (None, b), (None, b), (5, c)]).select("*", *(F.lit("clash").alias(x) for x in CLASHING))
    rows = sorted(((r.doc_id or 0, r.n_copies, bool(r.repeats), bool(r.shared), tuple(r.sources)) for r in s.find_repeats(docs).collect()), key=str)
    assert rows == sorted([(1, 4, False, True, ()), (1, 4, False, True, ()), (2, 4, True, True, (1,)), (0, 4, True, True, (1,)), (0, 2, False, True, ()), (0, 2, False, True, ()), (5, 1, False, False, ())], key=str)
