"""Merging of field derivations."""

from __future__ import annotations

import itertools
import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.operators import derivations

SCHEMA = f"id string, rank int, modes array<string>, fields {derivations.FIELDS}"
PARTS = [
    ("r", 1, ["first"], {"a": {"mode": "declared", "x": "1"}, "b": {"mode": None}}),
    ("r", 2, None, {"a": {"mode": "extracted", "y": "2"}, "b": {"mode": "late", "z": "3"}}),
    ("r", 3, ["  ", "<b>last</b>  one"], {"a": {"x": "9", "y": "9", "w": "4"}, "c": {"mode": "m" * 400}}),
    ("s", 2, [], {}), ("t", 1, None, None),
]
WANT = {"r": (["declared", "first", "last one", "m" * 299 + "…"], {"a": {"mode": "declared", "x": "1", "y": "2", "w": "4"}, "b": {"mode": None, "z": "3"}, "c": {"mode": "m" * 400}}), "s": ([], {}), "t": ([], {})}


def test_any_order_gives_one_result(spark):
    for order in itertools.permutations(PARTS[:3]):
        parts = reduce(DataFrame.unionAll, (spark.createDataFrame([p], SCHEMA) for p in (*order, *PARTS[3:])))
        got = {r.id: (r.modes, r.fields) for r in derivations.merge(parts).collect()}
        assert got == WANT


def test_merge_is_associative(spark):
    row = spark.createDataFrame([tuple(p[3] for p in PARTS[:3])], ", ".join(f"m{i} {derivations.FIELDS}" for i in range(3)))
    m = [F.col(f"m{i}") for i in range(3)]
    left, right = (derivations.merged_fields(derivations.merged_fields(m[0], m[1]), m[2]), derivations.merged_fields(m[0], derivations.merged_fields(m[1], m[2])))
    got = row.select(left.alias("l"), right.alias("r")).first()
    assert got.l == got.r == WANT["r"][1]


def test_equal_ranks_go_by_their_texts(spark):
    parts = [("r", 1, None, {"a": {"k": v}}) for v in ("2", "1", "3")]
    for order in itertools.permutations(parts):
        assert derivations.merge(spark.createDataFrame(order, SCHEMA).repartition(3)).first().fields == {"a": {"k": "1"}}


def test_fallback(spark):
    docs = [{"a": {"b": "x"}}, {"a": {"b": ""}, "c": "y"}, {"a": 1, "c": "NONE", "d": "z"}, {"a": {"b": 0}}, {"a": {"b": False}}, {}, None]
    rows = spark.createDataFrame([(json.dumps(d),) for d in docs], "t string").select(F.parse_json("t").alias("doc"))
    assert [r[0] for r in rows.select(derivations.fallback(F.col("doc"), ("a", "b"), ("c",), ("d",))).collect()] == ["x", "y", "z", "0", "false", None, None]
