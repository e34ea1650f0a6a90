"""Indicator documents: the rules that they must keep, and their records."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cairn.sources import indicators

GEOGRAPHY = {"countries": ["E", "W"], "levels": ["ltla"], "types": ["E06"], "year": 2023, "initialLevel": "ltla"}
EXTENSION = {
    "slug": "some-rate", "topic": "Health", "subTopic": "Smoking", "dataset": "d", "code": "c", "description": "About", "subtitle": "s", "measure": "m", "unit": "%", "frequency": "Annual", "periodDomain": ["2001", "2003"], "decimalPlaces": 1, "experimentalStatistic": False,
    "dataModified": "2024-01-01", "metadataModified": "2024-02-02", "geography": GEOGRAPHY, "source": [{"name": "Office A", "href": "https://a.example/x", "date": "2024"}],
}


def frame(spark, *docs):
    rows = [(i, d.get("title", "A rate"), d.get("caveats", []), ["x"], json.dumps(EXTENSION | d.get("extension", {}))) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "k long, title string, caveats array<string>, dimensions array<string>, e string").withColumn("extension", F.from_json("e", indicators.EXTENSION)).drop("e")


@pytest.mark.parametrize(
    ("doc", "rules"),
    [
        ({}, []), ({"title": " "}, ["title"]), ({"caveats": None}, ["caveats"]), ({"extension": {"slug": "Some Rate"}}, ["slug"]), ({"extension": {"unit": ""}}, ["required unit"]), ({"extension": {"periodDomain": ["2001"]}}, ["period"]), ({"extension": {"decimalPlaces": 13}}, ["decimal places"]),
        ({"extension": {"experimentalStatistic": None}}, ["flags"]), ({"extension": {"source": []}}, ["no source"]), ({"extension": {"source": [{"name": "A", "href": "http://a.example", "date": "2024"}]}}, ["source"]), ({"extension": {"geography": GEOGRAPHY | {"countries": ["E", "E"]}}}, ["countries"]),
        ({"extension": {"geography": GEOGRAPHY | {"types": ["X06"]}}}, ["area codes"]), ({"extension": {"geography": GEOGRAPHY | {"year": 1800}}}, ["vintage"]), ({"extension": {"geography": GEOGRAPHY | {"initialLevel": "ward"}}}, ["initial level"]),
    ],
)
def test_faults(spark, doc, rules):
    assert sorted(r.rule for r in indicators.indicator_faults(frame(spark, doc), "k").collect()) == rules


def test_records(spark):
    a, b, nameless = ({"name": n, "href": f"https://{n[-1].lower()}.example/", "date": "2024"} for n in ("Office A", "Office B", "<i></i>"))
    docs = [{"extension": {"slug": f"r{i}", "source": s}, "caveats": c} for i, (s, c) in enumerate([([a], ["Mind &amp; see", " "]), ([a, b], []), ([nameless], [])])]
    aliases = spark.createDataFrame([("old-b", "r0"), ("old-a", "r0"), ("x", "none")], "alias string, target string")
    got = {r.native_id: r for r in indicators.indicator_records(frame(spark, *docs), aliases).collect()}
    assert [(got[k].publisher, got[k].publisher_title, got[k].publisher_uri) for k in ("r0", "r1", "r2")] == [
        ("office-a", "Office A", "https://a.example/"), ("multiple-source-producers", "2 attributed source producers", None), ("source-producer-not-evidenced", "Source producer not evidenced", None),
    ]
    assert got["r0"].native_aliases == ["old-a", "old-b"] and got["r1"].native_aliases == [] and got["r0"].area_served == ["England", "Wales"] and got["r0"].quality_notes == ["Mind & see"]
    assert sorted(got["r0"].derivation) == ["area_served", "documentation_host", "endpoint_host", "quality_notes", "type"] and "quality_notes" not in got["r1"].derivation
    assert got["r0"].derivation_modes == sorted({*indicators.GIVEN_MODES, "source-declared", "controlled-vocabulary-crosswalk", "deterministic-extraction"})
    assert indicators.indicator_records(frame(spark).limit(0), aliases).count() == 0
