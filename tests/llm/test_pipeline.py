from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from cairn.llm import decontamination, quality_classifier
from cairn.llm.common import words
from test_decontamination import brute as leaked_by_definition
from test_line_dedup import brute as lines_by_definition
from test_ngram_join import brute as classes_by_definition

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = decontamination.materialize(stage(spark, docs, SF), name)
        counts.append(docs.count())
        kept[name] = docs
        if name != "tokens":
            assert docs.columns == columns
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    model = quality_classifier.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"), where=quality_classifier.training_rows())
    assert quality_classifier.score(kept["quality"], model).where("predicted = 0").count() == 0
    grams = {tuple(w[k : k + 10]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() for w in [words(r.text)] for k in range(len(w) - 9)}
    for r in kept["leaks"].collect():
        w = words(r.text or "")
        assert not any(tuple(w[k : k + 10]) in grams for k in range(len(w) - 9))


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(r.n_tokens == len(r.token_ids) for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)


def test_run_against_brute_force(spark):
    """All five stages by their definitions, over all rows of the smallest table; only the learnt model is taken as it is."""
    docs, labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    model = quality_classifier.fit(docs, labels, where=quality_classifier.training_rows())
    rows = [(r.doc_id, r.text) for r in docs.collect()]

    def good(text):
        x = quality_classifier.matrix([quality_classifier.features(text)])[0]
        margin = model.base + sum(t[sum(c <= x[f] for c in model.cuts[f])] for f, t in enumerate(model.tables))
        margin += sum(t[sum(c <= x[a] for c in model.coarse[a]), sum(c <= x[b] for c in model.coarse[b])] for (a, b), t in zip(model.pairs, model.pair_tables, strict=True))
        return 1 / (1 + np.exp(-margin)) >= 0.3

    rows = [r for r in rows if good(r[1])]
    new = lines_by_definition(rows)
    changed = [(i, t if t is None else new[i, t] or "") for i, t in rows]
    rows = [(i, t) for (i, t), (_, old) in zip(changed, rows, strict=True) if t is None or t == old or t.strip(" ")]
    classes = classes_by_definition(rows)
    rows = [(i, t) for i, t in rows if t is None or classes[i][0] == i]
    hit = leaked_by_definition(dict(rows), [(r.item_id, r.text) for r in items.collect()])
    rows = [(i, t) for i, t in rows if not hit[i][1]]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    want = sorted((i, t, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows)
    got = sorted((r.doc_id, r.text, list(r.token_ids)) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want
