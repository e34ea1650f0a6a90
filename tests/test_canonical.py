"""Levels of documents meet without a broadcast, since they grow with the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import variants


def test_levels_are_not_broadcast(spark):
    rows = spark.range(3).select("id", F.parse_json(F.lit('{"b":{"Z":[1,2],"a":"x"},"A":null}')).alias("doc"))
    got = variants.canonical_text(rows, "id", "doc")
    found = {tuple(r) for r in got.collect()}
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert found == {(k, '{"A":null,"b":{"a":"x","Z":[1,2]}}') for k in range(3)}
