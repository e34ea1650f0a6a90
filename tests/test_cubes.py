"""Cubes decoded against plain loops, the rules on their shape, and a register with its documents and aliases."""

from __future__ import annotations

import itertools
import json

import pytest
from pyspark.sql import functions as F

from cairn.sources import cubes


def item(**changes):
    dims = {"areacd": ["E1", "E2", "E3"], "period": ["2001", "2002"], "measure": ["n", "rate"]}
    doc = {
        "version": "2.0", "class": "dataset", "label": "Some", "id": list(dims), "size": [len(v) for v in dims.values()], "role": {"geo": ["areacd"], "time": ["period"]}, "value": [],
        "dimension": {d: {"label": d.title(), "category": {"index": {c: i for i, c in enumerate(v)}, "label": {v[0]: f"first {v[0]}"}}} for d, v in dims.items()},
        "extension": {"slug": "some", "topic": "t", "subTopic": "s", "dataset": "d", "code": "c"},
    }
    return doc | changes


def frame(spark, *docs):
    return spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "k long, text string").select("k", F.from_json("text", cubes.ITEM).alias("item")).repartition(3)


def test_digits(spark):
    sizes = [3, 1, 4, 2]
    rows = spark.createDataFrame([(sizes, i) for i in range(-1, 25)] + [([2, 0], 0), ([], 0), ([], 1), (None, 0), (sizes, None)], "sizes array<int>, place long")
    got = [r[0] for r in rows.select(cubes.digits(F.col("sizes"), F.col("place"))).collect()]
    assert got == [None, *map(list, itertools.product(*map(range, sizes))), None, None, [], None, None, None]


def test_cells(spark):
    values = [float(i) if i % 5 else None for i in range(12)]
    got = cubes.cells(frame(spark, item(value=values), item(), item(value=[1.0] * 13)), "k").collect()
    names = list(itertools.product(["E1", "E2", "E3"], ["2001", "2002"], ["n", "rate"]))
    assert sorted((tuple(r.coordinates.values()), r.value) for r in got if r.k == 0) == [(n, v) for n, v in zip(names, values, strict=True) if v is not None]
    assert sum(r.k == 2 for r in got) == 13 and not any(r.k == 1 for r in got)


def test_dimension_rows(spark):
    rows = {r.dimension: r for r in cubes.dimension_rows(frame(spark, item()), "k").collect()}
    assert {d: (r.order, r.role, r["count"], r.projection) for d, r in rows.items()} == {"areacd": (0, "geo", 3, "count-only"), "period": (1, "time", 2, "count-only"), "measure": (2, "measure", 2, "identifiers-and-labels")}
    assert [tuple(c) for c in rows["measure"].categories] == [("n", "first n"), ("rate", None)] and rows["areacd"].categories is None


def other(dimension, **category):
    doc = item()
    doc["dimension"][dimension]["category"] |= category
    return doc


@pytest.mark.parametrize(
    ("doc", "rules"),
    [
        (item(), []), (item(version="1.0"), ["class"]), (item(**{"class": "collection"}), ["class"]), (item(value=[1.0]), ["values"]), (item(status={"0": "p"}), ["statuses"]), (item(size=[3, 2]), ["category index", "dimension order"]),
        (item(size=[3, 2, 3]), ["category index"]), (other("period", index={"2001": 0, "2002": 2}), ["category index"]), (other("period", label={"1999": "x"}), ["unknown label"]), (item(role={"geo": ["areacd"], "time": ["areacd"]}), ["several roles"]),
        (item(id=["areacd", "period", "weight"]), ["category index", "dimension lookup", "unreviewed dimension"]), (item(id=["areacd", "areacd", "measure"]), ["category index", "dimension lookup", "dimension order"]),
    ],
)
def test_item_faults(spark, doc, rules):
    assert sorted(r.rule for r in cubes.item_faults(frame(spark, doc), "k").collect()) == rules


REGISTER = "row long, slug string, topic string, subTopic string, dataset string, code string, include string"


def test_golden_counts(spark):
    """120 rows of which 108 are included; of 52 aliases six have a target that is known to be missing."""
    rows = [(i, f"part-{i}", "t", "s", "d", str(i), "TRUE") if i % 10 else (i, "", None, " ", "d", str(i), "false") for i in range(1, 121)]
    register = spark.createDataFrame(rows, REGISTER)
    included, excluded = cubes.split_register(register)
    assert (included.count(), excluded.count(), cubes.register_faults(register).count()) == (108, 12, 0)
    docs = frame(spark, *(item(extension={"slug": f"part-{i}", "topic": "t", "subTopic": "s", "dataset": "d", "code": str(i)}) for i in range(1, 121) if i % 10))
    assert cubes.closure_faults(included, docs).count() == 0
    aliases = spark.createDataFrame([(f"old-{i}", f"part-{i if i % 10 else i + 1}") for i in range(1, 47)] + [(f"gone-{i}", f"no-{i}") for i in range(6)], "alias string, target string")
    missing = spark.createDataFrame([(f"gone-{i}", f"no-{i}") for i in range(6)], "alias string, target string")
    out = cubes.project_aliases(aliases, included, missing)
    assert {r.outcome: r["count"] for r in out.groupBy("outcome").count().collect()} == {"accepted": 46, "excluded": 6}


def test_alias_faults(spark):
    published = spark.createDataFrame([("a",), ("b",)], "slug string")
    aliases = spark.createDataFrame([("x", "a"), ("c", "c"), ("b", "a"), ("y", "none"), ("Bad Alias", "a"), ("z", "gone"), ("w", "b")], "alias string, target string")
    known = spark.createDataFrame([("z", "gone"), ("v", "also-gone"), ("w", "b")], "alias string, target string")
    assert {r.alias: r.outcome for r in cubes.project_aliases(aliases, published, known).collect()} == {
        "x": "accepted", "c": "alias of itself", "b": "shadows a published slug", "y": "unexplained missing target", "Bad Alias": "unsafe alias", "z": "excluded", "v": "known missing alias is gone", "w": "known missing target is published",
    }


def test_register_and_closure_faults(spark):
    rows = [
        (1, "a", "t", "s", "d", "1", "true"), (2, "a", "t", "s", "d", "2", "True"), (3, "B", "t", "s", "d", "3", "true"), (4, "c", None, "s", "d", "4", "true"), (5, "d", "", "", "d", "5", "false"), (6, None, None, None, " ", "6", "false"), (7, None, None, None, "d", "7", None),
    ]
    got = sorted((r.row, r.rule) for r in cubes.register_faults(spark.createDataFrame(rows, REGISTER)).collect())
    assert got == [(1, "slug occurs twice"), (2, "slug occurs twice"), (3, "slug"), (4, "taxonomy"), (5, "excluded but classed"), (6, "dataset and code"), (7, "include")]
    ext = lambda slug, topic="t": item(extension={"slug": slug, "topic": topic, "subTopic": "s", "dataset": "d", "code": "1"})
    included = spark.createDataFrame([(1, "a", "t", "s", "d", "1", "true"), (2, "b", "t", "s", "d", "1", "true"), (3, "c", "t", "s", "d", "1", "true")], REGISTER)
    faults = cubes.closure_faults(included, frame(spark, ext("a"), ext("b", "u"), ext("b", "u"), ext("e")))
    assert sorted(map(tuple, faults.collect())) == [("b", "disagree on topic"), ("b", "several documents"), ("c", "no document"), ("e", "not in the register")]
