"""The allowlist of keywords, pinned schemas, and assertions with identities."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from cairn.operators import schemas


def frame(spark, docs):
    return spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "k long, text string").select("k", "text", F.parse_json("text").alias("doc")).repartition(3)


def plain(schema, path="$"):
    out = [(path, k) for k in schema if k not in schemas.KEYWORDS]
    for k in ("properties", "$defs"):
        if isinstance(schema.get(k), dict):
            out += [x for n, c in schema[k].items() if isinstance(c, dict) for x in plain(c, f"{path}.{k}[{n!r}]")]
    for k in ("items", "if", "then", "additionalProperties"):
        if isinstance(schema.get(k), dict):
            out += plain(schema[k], f"{path}.{k}")
    for k in ("allOf", "oneOf"):
        if isinstance(schema.get(k), list):
            out += [x for i, c in enumerate(schema[k]) if isinstance(c, dict) for x in plain(c, f"{path}.{k}[{i}]")]
    return out


def test_unknown_keywords_wherever_schemas_are(spark):
    docs = [
        {"type": "object", "properties": {"maxLength": {"type": "string", "maxLength": 3}, "not": True}}, {"$defs": {"a": {"oneOf": [{"not": {}}, 1, {"allOf": [{"anyOf": []}]}]}}}, {"items": {"items": {"items": {"contains": 1, "minLength": 2}}}},
        {"const": {"maxLength": 1}, "enum": [{"not": 1}], "required": ["not"], "title": "not"}, {"additionalProperties": False, "if": {"x": 1}, "then": {"y": 1, "z": 2}, "allOf": {"not": 1}, "properties": [{"not": 1}]}, {}, True, {"deprecated": True},
    ]
    got = sorted(map(tuple, schemas.unknown_keywords(frame(spark, docs), "k", "doc").collect()))
    assert got == sorted((i, *x) for i, d in enumerate(docs) if isinstance(d, dict) for x in plain(d))


def test_pins(spark):
    rows = frame(spark, [{"a": 1}, {"a": 2}, {"a": 3}])
    pins = {"0": hashlib.sha256(b'{"a": 1}').hexdigest(), "1": "0" * 64}
    got = {r.k: r.expected for r in schemas.pinned(rows, "k", "text", pins).collect()}
    assert got == {"1": "0" * 64, "2": None}


def test_assertions(spark):
    schema = {"type": "object", "required": ["@id", "target"], "properties": {"@id": {"type": "string"}, "target": {"type": "object", "required": ["@id"]}}}
    docs = [("s", {"@id": "1", "target": {"@id": "t"}}), ("s", {"@id": "1", "target": {}}), ("s", {"target": 3}), ("r", {"@id": "1", "target": {"@id": "t"}}), ("r", {"@id": "2"})]
    rows = spark.createDataFrame([(p, json.dumps(d)) for p, d in docs], "plane string, text string").select("plane", F.parse_json("text").alias("doc"))
    assert sorted(map(tuple, schemas.assertion_faults(rows, schema).collect())) == [("r", "2", "$:required target"), ("s", "", "$.target:type"), ("s", "", "$:required @id"), ("s", "1", "$.target:required @id"), ("s", "1", "identity occurs twice")]
    sets = {r.plane: (r.n, r.digest) for r in schemas.identity_sets(rows.where("plane = 'r'").unionAll(rows.where("plane = 'r'").withColumn("plane", F.lit("again")))).collect()}
    assert sets["r"] == sets["again"] and sets["r"][0] == 2


def test_assertions_of_several_planes_come_once(spark):
    schema = {"type": "object", "required": [f"r{k}" for k in range(70)], "properties": {"@id": {"pattern": "^u"}}}
    docs = [(["s", "r"], {"@id": "u1", **{f"r{k}": 1 for k in range(70) if k not in (0, 59, 60, 69)}}), (["s"], {"@id": "u1", **{f"r{k}": 1 for k in range(70)}}), (["s", "r"], {"@id": "x", **{f"r{k}": 1 for k in range(70)}})]
    rows = spark.createDataFrame([(p, json.dumps(d)) for p, d in docs], "planes array<string>, text string").select("planes", F.parse_json("text").alias("doc"))
    each = rows.select(F.explode("planes").alias("plane"), "doc")
    want = [(p, "u1", f"$:required r{k}") for p in "rs" for k in (0, 59, 60, 69)] + [("s", "u1", "identity occurs twice"), ("r", "x", "$.@id:pattern"), ("s", "x", "$.@id:pattern")]
    for given in (rows, each):
        found = schemas.assertion_faults(given, schema)
        assert sorted(map(tuple, found.collect())) == sorted(want)
        assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    assert sorted(map(tuple, schemas.identity_sets(rows).collect())) == sorted(map(tuple, schemas.identity_sets(each).collect()))
    assert schemas.identity_sets(rows)._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 4
