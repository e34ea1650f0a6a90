"""op10's threshold comes from all labelled good rows, and its trees draw from all of them."""

from __future__ import annotations

import random

import numpy as np

from cairn.llm import quality_rules


def test_every_labelled_good_row_counts(spark):
    n = 15_000  # more than any sample held before
    rng = random.Random(5)
    rows = [(k, " ".join("ab" * rng.choice((1, 2, 3)) + ("$" if rng.random() < 0.1 else "") + str(i) for i in range(50 + k % 7))) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = spark.range(n).selectExpr("id AS doc_id", "CASE WHEN id % 40 = 0 THEN 0 ELSE 1 END AS quality")
    own = quality_rules.measured(docs).localCheckpoint()
    forest = quality_rules.learnt(own, labels)
    got = quality_rules.judged(own, forest).join(labels, "doc_id").where("NOT base_failed AND quality = 1").select("kept", "anomaly_score").toArrow()
    scores, kept = np.sort(np.asarray(got["anomaly_score"])), np.asarray(got["kept"])
    least = scores[-1 - int(0.004 * len(scores))]
    assert len(scores) > 12_000 and forest.threshold == np.nextafter(least, 2.0)
    assert (~kept).sum() == (scores > least).sum() <= int(0.004 * len(scores))
    again = quality_rules.learnt(own.repartition(3), labels)
    assert again.threshold == forest.threshold and (again.split == forest.split).all()


def test_nth_greatest(spark):
    rng = random.Random(1)
    values = [rng.choice((0.5, 0.25, rng.random(), 0.5 + rng.random() * 1e-15)) for _ in range(3_000)]
    rows = spark.createDataFrame([(v,) for v in values], "score double").localCheckpoint()
    for n in (0, 1, 700, 1_500, 2_999):
        assert quality_rules.nth_greatest(rows, n) == sorted(values, reverse=True)[n]
