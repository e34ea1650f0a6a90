"""Walks through nested documents against plain recursion."""

from __future__ import annotations

import json
from collections import deque

from pyspark.sql import functions as F

from cairn.operators import variants

DOCS = [
    {"a": {"Total-Price": "x", "b": {"total_price": 3}}, "c": {"TOTAL_PRICE": " 4.5 "}}, {"total-price": True, "z": [{"total_price": "0x1F"}]}, {"total_price": None}, {}, [], [[1, [{"total_price": "1e400"}, {"total_price": 9}]]],
    "text", None, {"a": {"b": {"c": {"d": {"e": {"total_price": 1}}}}}}, {"a": {"b": {"c": {"d": {"e": {"f": {"total_price": 1}}}}}}}, {"total_price": "", "x": {"total_price": -0.5}}, {"total_price": [1], "b": [{"total_price": "7"}]},
]


def frame(spark, docs):
    return spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "k long, text string").select("k", F.parse_json("text").alias("doc")).repartition(3)


def children(node):
    return sorted(node.items()) if isinstance(node, dict) else list(enumerate(node)) if isinstance(node, list) else []


def number(x):
    if isinstance(x, bool) or not isinstance(x, (int, float, str)):
        return None
    try:
        value = float(int(x.strip(), 16)) if isinstance(x, str) and x.strip().lower().startswith("0x") else float(x)
    except ValueError:
        return None
    return value if abs(value) < float("inf") else None


def first_number(doc, wanted, depth=5):
    queue = deque([(doc, 0)])
    while queue:
        node, d = queue.popleft()
        if d > depth:
            continue
        for name, child in children(node):
            if isinstance(name, str) and name.replace("-", "_").lower() in wanted and number(child) is not None:
                return number(child)
            queue.append((child, d + 1))
    return None


def test_first_number(spark):
    got = dict(variants.first_number(frame(spark, DOCS), "k", "doc", ("total_price",)).collect())
    assert got == {i: first_number(d, {"total_price"}) for i, d in enumerate(DOCS)}
    assert got[8] == 1 and got[9] is None


def test_number_at(spark):
    docs = [{"a": {"b": " 12 "}}, {"a": {"b": "twelve"}}, {"a": 1}, {"a": {"b": False}}, {"a": {"b": 2.5}}, {"a b": {"b": 1}}, "x"]
    assert [r[0] for r in frame(spark, docs).orderBy("k").select(variants.number_at(F.col("doc"), ("a", "b"))).collect()] == [12.0, None, None, None, 2.5, None, None]


def points(node):
    if not isinstance(node, list):
        return []
    if len(node) >= 2 and all(isinstance(x, (int, float)) and not isinstance(x, bool) for x in node[:2]):
        return [tuple(map(float, node[:2]))]
    return [p for x in node for p in points(x)]


def test_numeric_points(spark):
    docs = [[1, 2], [[1, 2], [3, 4, 5]], [[[[1.5, -2]]], [[[0, 0], [9, 9]]]], [], [[]], {"x": [1, 2]}, [{"x": [1, 2]}, [5, 6]], [True, 1], [[True, 1], [1, True, [2, 3]]], ["1", 2], [[1]], None, 7, [[181, 0], [1, 1]]]
    got = variants.numeric_points(frame(spark, docs), "k", "doc")
    for i, d in enumerate(docs):
        assert [(r.x, r.y) for r in sorted(got.where(F.col("k") == i).collect(), key=lambda r: r["at"])] == points(d)
    assert {r.k: tuple(r)[1:] for r in variants.points_extent(got, "k").collect()}[2] == (0.0, -2.0, 9.0, 9.0) and 13 not in {r.k for r in variants.points_extent(got, "k").collect()}


def collection(node, names):
    if not isinstance(node, (dict, list)):
        return []
    for n in names:
        if isinstance(node, dict) and isinstance(node.get(n), list):
            return node[n]
    for _, child in children(node):
        if isinstance(child, dict) and collection(child, names):
            return collection(child, names)
    return []


def test_first_collection(spark):
    docs = [
        {"items": [1]}, {"results": [], "a": {"items": [1]}}, {"a": {"items": [], "b": {"items": [1]}}, "c": {"results": [2, 3]}}, {"a": [{"items": [1]}], "b": {"items": [4]}}, {}, "x", {"a": {"b": {"results": ["q"], "items": 3}}},
        {"results": [1], "items": [2, 2]},
    ]
    got = {r.k: json.loads(r.j or "[]") for r in variants.first_collection(frame(spark, docs), "k", "doc", ("items", "results")).select("k", F.to_json("items").alias("j")).collect()}
    assert got == {i: collection(d, ("items", "results")) for i, d in enumerate(docs)}


def ordered(node):
    if isinstance(node, dict):
        return {k: ordered(v) for k, v in sorted(node.items(), key=lambda p: p[0].lower())}
    return [ordered(x) for x in node] if isinstance(node, list) else node


def test_canonical_text(spark):
    docs = [{"b": 1, "A": [3, {"z": None, "Y": {"d": "q\"é\n", "C": []}}], "a0": {}}, [], {}, "s", 1, None, {"k\"1": {"B": [[1, 2], [3]], "a": True}}]
    got = {r.k: r.text for r in variants.canonical_text(frame(spark, docs), "k", "doc").collect()}
    assert got == {i: json.dumps(ordered(d), separators=(",", ":"), ensure_ascii=False) for i, d in enumerate(docs)}


def test_depth_ends_a_walk(spark):
    rows = frame(spark, [{"a": {"b": {"c": 1}}}])
    assert variants.walk(rows, "k", "doc", depth=2).agg(F.max("depth")).first()[0] == 2
    assert variants.walk(rows, "k", "doc").agg(F.max("depth")).first()[0] == 3
    assert variants.walk(frame(spark, [1]), "k", "doc").count() == 0
