"""Joins that checks share, with nulls, repeats and empty tables."""

from __future__ import annotations

from cairn.operators import joins


def test_key_sets(spark):
    make = lambda *k: spark.createDataFrame([(x,) for x in k], "k int")
    assert tuple(joins.key_sets(make(1, 2, 2, None), make(2, 3, None), "k").first()) == (2, 1, 1, 1, False)
    assert tuple(joins.key_sets(make(1, 1), make(1), "k").first()) == (1, 1, 0, 0, True)
    assert tuple(joins.key_sets(make(), make(), "k").first()) == (0, 0, 0, 0, True)


def test_overlaid(spark):
    base, extra = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "n")], "k int, v string"), spark.createDataFrame([(1, "x"), (2, None), (3, "z"), (9, "y")], "k int, value string")
    assert sorted(map(tuple, joins.overlaid(base, extra, "k", "v").collect()), key=str) == sorted([(1, "x", True), (2, "b", False), (3, "z", True), (None, "n", False)], key=str)


def test_by_either_key(spark):
    rows, entries = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None), (None, "1")], "id string, own string"), spark.createDataFrame([("a", "by id"), ("1", "by own"), ("2", "two")], "key string, entry string")
    assert {(r.id, r.own): r.entry for r in joins.by_either_key(rows, entries, "id", "own").collect()} == {("a", "1"): "by id", ("b", "2"): "two", ("c", None): None, (None, "1"): "by own"}


def test_pairs_counterparts_and_repeats(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, "x"), (3, None, "x")], "k int, s string, t string")
    assert sorted(r.k for r in joins.not_allowed(rows, spark.createDataFrame([("a", "x"), ("a", "x"), (None, "x")], "s string, t string"), "s", "t").collect()) == [2, 3, 3]
    assert sorted(r.k for r in joins.without_counterpart(rows, rows.where("k = 3"), "k").collect()) == [1, 2]
    assert [tuple(r) for r in joins.repeated(rows, "k", "s").collect()] == [(3, None)]
