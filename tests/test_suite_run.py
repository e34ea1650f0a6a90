"""Runs of a suite: each task hands on its best rows alone, and records that are given twice count once."""

from __future__ import annotations

import pyarrow as pa

from cairn.operators import evaluation as ev
from cairn.sources.records import COLUMNS


def test_a_task_hands_on_its_best_rows():
    suite = ev.Suite([(1, ["aa", "bb"]), (2, ["bb", "zz"]), (3, [])])
    tokens = [["aa", "bb"] if k % 50 == 0 else ["bb"] for k in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array([f"r{k:04}" for k in range(2000)]), pa.array(["t"] * 2000), pa.array(tokens, pa.list_(pa.string()))], ["id", "low", "t0"])
    got = [tuple(r.values()) for out in ev.best_of(suite, [6], 10, [batch, batch.slice(0, 0)]) for r in out.to_pylist()]
    assert got == [(0, 2, 12, "t", f"r{k * 50:04}") for k in range(10)] + [(1, 1, 6, "t", f"r{k:04}") for k in range(10)]


def test_records_given_twice_count_once(spark):
    rows = [("a", "one two", None), ("b", "one", "two"), ("b", "one", "two"), ("c", None, "one"), (None, "two", None)]
    own = spark.createDataFrame(rows, "id string, title string, notes string")
    kinds = {c: k for c, k in COLUMNS.items() if c not in own.columns}
    records = own.selectExpr("*", *(f"CAST({'array()' if k.startswith('array') else 'NULL'} AS {k}) AS {c}" for c, k in kinds.items()))
    suite = spark.createDataFrame([(7, ["one", "two"]), (8, ["nothing"])], "query_id long, terms array<string>")
    got = {(r.query_id, r.id, r["rank"]) for r in ev.run(records, suite).collect()}
    assert got == {(7, "b", 1), (7, "a", 2), (7, None, 3), (7, "c", 4)}


def test_judgements_shuffle_no_texts(spark, monkeypatch):
    """documents meet the suite's passages where they are read."""
    from cairn.plans import evaluation

    kept = []
    monkeypatch.setattr(evaluation, "materialize", lambda df, name: kept.append(df) or df)
    kept.append(evaluation.qrels(spark, "/root/testdata/sf0.001"))
    plans = [line for df in kept for line in df._jdf.queryExecution().executedPlan().toString().splitlines()]
    assert not [line for line in plans if "Join [doc_id" in line and "Inner" in line]
