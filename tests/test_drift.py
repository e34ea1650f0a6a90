"""Three-way drift, packs, and specifications of measures."""

from __future__ import annotations

import itertools

import pytest

from cairn.operators import drift, telemetry

ROW = "k long, a string, b string"


def test_every_class_occurs(spark):
    kinds = {(s, o, b): None for s, o, b in itertools.product(("x", "y", None), repeat=3)}
    for s, o, b in kinds:
        kinds[s, o, b] = None if s == o == b else "provider-changed" if s == b else "snapshot-changed" if o == b else "both-changed-alike" if s == o else "conflicting"
    cases = list(kinds)
    side = lambda n: spark.createDataFrame([(i, c[n], "same") for i, c in enumerate(cases)], ROW)
    got = {r.k: r.drift for r in drift.drift(side(0), side(1), side(2), "k", ["a", "b"]).collect()}
    assert got == {i: kinds[c] for i, c in enumerate(cases) if kinds[c]} and set(got.values()) == {"provider-changed", "snapshot-changed", "both-changed-alike", "conflicting"}


def test_records_that_a_side_lacks(spark):
    s, o, b = (spark.createDataFrame(rows, ROW) for rows in ([(1, "x", "x"), (2, "x", "x"), (5, "x", "y")], [(1, "x", "x"), (3, "x", "x"), (4, "x", "x"), (5, "y", "y")], [(1, "x", "x"), (2, "x", "x"), (4, "x", "x"), (9, "x", "x")]))
    history = spark.createDataFrame([(5, "a", "y", "2026-03"), (5, "a", "y", "2026-01"), (5, "a", "x", "2025-01"), (5, "b", "y", "2024-01")], "k long, field string, value string, seen string")
    got = sorted(tuple(r) for r in drift.drift(s, o, b, "k", ["a", "b"], history).collect())
    assert got == [(2, "*", "gone-at-provider", None, None, None, None), (3, "*", "new-at-provider", None, None, None, None), (4, "*", "dropped-from-snapshot", None, None, None, None), (5, "a", "without-baseline", "x", "y", None, "2026-01")]


def test_packs(spark):
    records = spark.createDataFrame([(1, "red", "c1"), (2, "red", "c1"), (3, "blue", "c1"), (3, "blue", None)], "k long, colour string, commit string")
    columns = "pack string, field string, operator string, value string, expected long, commit string, live_commit string, live_status string"
    ok = "reviewed-reference-not-live-validated"
    packs = spark.createDataFrame([("good", "colour", "equals", "red", 2, "c1", "c2", ok), ("blue", "colour", "equals", "blue", 1, "c1", "c1", "live"), ("none", "colour", "equals", "green", 1, "c1", "c2", ok), ("odd", "k", "contains", "1", 1, "c1", "c2", ok), ("one", "k", "equals", "1", 1, "c1", "c2", ok)], columns)
    taken = drift.select_pack(records, packs, ["colour", "k"])
    assert sorted((r.pack, r.k) for r in taken.collect()) == [("blue", 3), ("blue", 3), ("good", 1), ("good", 2), ("one", 1)]
    got = sorted(map(tuple, drift.pack_faults(packs, taken, "k", spark.createDataFrame([("good",), ("one",)], "pack string")).collect()))
    assert got == [("blue", r) for r in ("drift without a difference", "drift without another commit", "record count", "record ids repeat", "reference status", "source commit")] + [("none", "selector matches nothing"), ("odd", "selector")]


MEASURED = "run long, measure string, value double, minimum double, maximum double, exact boolean, unit string, scope string, source string"


@pytest.mark.parametrize(
    ("change", "rules"),
    [
        ({}, []), ({"measure": "other", "unit": None}, ["unregistered measure"]), ({"exact": None}, ["exact flag"]), ({"value": None}, ["exact value"]), ({"minimum": 1.0}, ["exact value"]), ({"value": None, "exact": False}, []), ({"source": " "}, ["source"]),
        ({"source": "my Estimation"}, ["estimate called exact"]), ({"source": "my Estimation", "exact": False}, []), ({"unit": "token"}, ["unit"]), ({"scope": None}, ["scope"]), ({"value": float("nan")}, ["value"]), ({"value": float("inf")}, ["value"]), ({"value": -0.5}, ["value"]),
        ({"value": 11.0}, ["value"]), ({"exact": False, "minimum": 5.0, "maximum": 4.0}, ["range"]), ({"exact": False, "minimum": 0.5, "maximum": 10.0}, ["minimum"]), ({"exact": False, "minimum": 1.0, "maximum": 99.0, "value": None}, ["maximum"]),
    ],
)
def test_measurements(spark, change, rules):
    row = {"run": 1, "measure": "m", "value": 3.0, "minimum": None, "maximum": None, "exact": True, "unit": "tokens", "scope": "task", "source": "log"} | change
    specs = spark.createDataFrame([("m", "tokens", "task", 1.0, 10.0)], telemetry.SPECIFICATION)
    got = telemetry.measurement_faults(spark.createDataFrame([tuple(row.values())], MEASURED), specs).collect()
    assert sorted(r.rule for r in got) == rules and {(r.run, r.measure) for r in got} <= {(1, row["measure"])}
