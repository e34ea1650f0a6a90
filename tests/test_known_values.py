"""Values that must come out as published: table codes, version links, refusals and the corpus of repeated records."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cairn.functions.shapes import declared_codes
from cairn.operators import broker, validate
from cairn.sources.lanes import version_identity
from cairn.sources.records import corpus_of, records

SF = "/root/testdata/sf0.001"


def test_declared_codes(spark):
    cases = [
        ("TS001", "TS001 - Number of usual residents", ["TS001"]), ("ts002", "", ["TS002"]), ("NM_1", "KS101EW - Usual residents", ["KS101EW"]), ("ks101", "KS101EW: residents", ["KS101", "KS101EW"]), ("NM_1", "KS101EW residents", []),
        ("NM_1", " dc111ew – age", ["DC111EW"]), ("NM_1", "QS201", ["QS201"]), ("TS0011", None, []), (None, None, []),
    ]
    rows = spark.createDataFrame([c[:2] for c in cases], "n string, t string")
    assert [r[0] for r in rows.select(declared_codes(F.col("n"), F.col("t"))).collect()] == [c[2] for c in cases]


@pytest.mark.parametrize(
    ("link", "want"),
    [
        ("https://h/v1/datasets/cpih01/editions/time-series/versions/9", ("cpih01", "time-series", "9")), ("https://h/v1/datasets/cpih01/editions/time-series", (None, None, None)), ("https://h/datasets/x", (None, None, None)),
        ("https://h/datasets/x/editions/e/versions/3?a=1#b", ("x", "e", "3")), ("https://h/editions/e/datasets/x/versions/3", (None, None, None)), ("", (None, None, None)),
    ],
)
def test_version_links_are_all_or_nothing(spark, link, want):
    known = version_identity(F.lit(link))
    assert tuple(spark.range(1).select(known["dataset"], known["edition"], known["version"]).first()) == want


@pytest.mark.parametrize(
    ("value", "refused"),
    [
        ({"analysis": "x"}, False), ({"Chain-of-Thought": 1}, True), ({"a": [{"Bearer": 1}]}, True), ("C:\\\\Users\\\\me", True), ("C:\\Users\\me", False), ("/users/me", True), ("/tmp/x", False), ("eyJabcdefghijk.abcdefghijkl.abcdefgh", False),
        ("sk-abcdefghijkl", True), ("Bearer abcdefghijkl", True), ("gho_abcdefghijklmnopqrst", True), ("AIza" + "a" * 30, True), ("AIza" + "a" * 29, False),
    ],
)
def test_requests_and_publications_have_lists_of_their_own(value, refused):
    if refused:
        with pytest.raises(broker.Refused):
            broker.guard(value)
    else:
        broker.guard(value)


def test_publications(spark):
    rows = spark.createDataFrame([(["analysis", "ok"], "/tmp/x"), (["bearer"], "Bearer abcdefghijkl"), ([" Chain-Of-Thought"], ""), ([], "C:\\\\Users\\\\me"), (None, None)], "n array<string>, t string")
    got = [r[0] for r in rows.select(validate.unpublishable(F.coalesce("n", F.array().cast("array<string>")), F.coalesce("t", F.lit("")))).collect()]
    assert got == [["name:analysis", "text:local_path"], [], ["name:chain_of_thought"], [], []]


def test_corpus_holds_an_id_once(spark):
    own = records(spark, SF, "parts", "suppliers")
    n = own.count()
    thrice = corpus_of(own.unionAll(own).unionAll(own.withColumn("title", F.lit("~~~"))).repartition(5))
    assert thrice.count() == n and thrice.where("title = '~~~'").count() == 0
    assert sorted(r.ordinal for r in thrice.select("ordinal").collect()) == list(range(n))
    assert corpus_of(own.limit(0)).count() == 0
