"""Structure definitions, code lists and version dimensions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cairn.sources import structures as s

RAW = "array<struct<kind: string, concept: string, codeList: string, attachmentLevel: string, assignmentStatus: string, position: int>>"


def test_components(spark):
    raw = [("Dimension", "a", "CL", None, "", None), ("group", "g", None, None, None, 9), (" TIMEDIMENSION", "t", "", None, None, 7), ("attribute", "x", None, "Series", "Mandatory", 3), ("dimension", "b", None, None, None, None), ("PrimaryMeasure", "m", None, None, None, None), (None, None, None, None, None, None)]
    row = spark.createDataFrame([(raw,), (None,), ([],)], f"raw {RAW}").select(s.components(F.col("raw")).alias("c"), s.dimensions_of(s.components(F.col("raw"))).alias("d")).collect()
    assert [tuple(c) for c in row[0].c] == [
        ("Dimension", "a", "CL", None, None, 1), ("TimeDimension", "t", None, None, None, 7), ("Attribute", "x", None, "Series", "Mandatory", None), ("Dimension", "b", None, None, None, 3), ("PrimaryMeasure", "m", None, None, None, None),
    ]
    assert [c.concept for c in row[0].d] == ["a", "t", "b"] and row[1].c == row[2].c == []


def lists(*given):
    return [{"concept": c, "codeList": n, "status": st, "reason": r, "codes": codes and [dict(zip(("value", "label", "revisionStatus"), (*x, None, None)[:3])) for x in codes]} for c, n, st, r, codes in given]


@pytest.mark.parametrize(
    ("codes", "want"),
    [
        ([("2019", "2019"), ("2021", "2021"), ("2020", "2020")], ("YYYY", True, "2019", "2021")), ([("2019", "2019"), ("2020", "2020", "Unreleased")], ("YYYY", True, "2019", "2019")), ([("2019-02", "Feb"), ("2018-12", "Dec")], ("YYYY-MM", True, "2018-12", "2019-02")),
        ([("2019", "a"), ("2019", "b")], ("YYYY", False, None, None)), ([("2019", "a"), ("2019-01", "b")], (None, False, None, None)), ([("2019-13", "a")], (None, False, None, None)), ([("2020", "2020 (not yet released)")], (None, False, None, None)),
        ([("2020", "a"), ("2021", "")], ("YYYY", True, "2020", "2020")), ([("3020", "a")], (None, False, None, None)),
    ],
)
def test_periods(spark, codes, want):
    rows = spark.createDataFrame([(lists(("time", "CL", "Present", None, codes)),)], f"lists {s.CODELISTS}")
    t = s.codelist_evidence(rows, "lists").first().time_evidence
    assert (t.period_format, bool(t.derived), t.start, t.end) == want


def test_frequencies_and_lists_that_evidence_nothing(spark):
    cases = [
        lists(("FREQ", "CL", "", None, [("A", "Annual")])), lists(("freq", "CL", None, None, [("A", "Annual"), ("M", "<b>monthly</b>")])), lists(("FREQ", "CL", "", None, [("X", "N/A")])), lists(("FREQ", "CL", "absent", None, [("A", "Annual")])),
        lists(("FREQ", "CL", "", None, [("A", "Annual")]), ("FREQ", "CL2", "", None, [("Q", "Quarterly")])), lists(("FREQ", "", "", None, [("A", "Annual")]), ("TIME", "CL", "Not-Evidenced", "gone", None)), None, [],
    ]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], f"k int, lists {s.CODELISTS}")
    got = {r.k: r for r in s.codelist_evidence(rows, "lists").collect()}
    f = lambda k: got[k].frequency_evidence and (got[k].frequency_evidence.frequency, got[k].frequency_evidence.labels, got[k].frequency_evidence.single, got[k].frequency_evidence.code_list)
    assert [f(k) for k in range(8)] == [("Annual", ["Annual"], True, "CL"), (None, ["Annual", "monthly"], False, "CL"), (None, [], False, "CL"), None, ("Quarterly", ["Quarterly"], True, "CL2"), None, None, None]
    assert [tuple(x) for x in got[5].not_evidenced] == [("TIME", "CL", "gone")] and got[6].not_evidenced == []


def test_version_dimensions(spark):
    kind = "array<struct<id: string, name: string, label: string, description: string, href: string, is_area_type: boolean, number_of_options: bigint>>"
    raw = [("a", "n", "l", None, "https://h.example/x?token=1", None, 5), (None, None, " ", "x", None, True, 1), ("a", "n", "l", "again", None, True, 2), ("a", None, None, None, "https://h.example/x", False, -1), (None, "Geography", None, None, None, None, 10**9), (None, None, "GEOGRAPHY", None, None, False, None), ("b", None, None, None, None, True, None)]
    rows = spark.createDataFrame([(raw,), ([(str(i), None, None, None, None, None, None) for i in range(150)],), (None,)], f"raw {kind}").select(s.version_dimensions(F.col("raw")).alias("d"))
    got = rows.select(s.first_named(F.col("d")).alias("d")).select("d", s.area_dimensions(F.col("d")).alias("areas")).collect()
    assert [(x.id, x.name, x.label, x.number_of_options) for x in got[0].d] == [("a", "n", "l", 5), ("a", None, None, None), (None, "Geography", None, None), (None, None, "GEOGRAPHY", None), ("b", None, None, None)]
    assert [x.id or x.name or x.label for x in got[0].areas] == ["Geography", "GEOGRAPHY", "b"] and len(got[1].d) == 100 and got[2].d is None


def test_summary_of_nested_rules(spark):
    kind = f"agency string, identifier string, version string, components array<{s.COMPONENT}>, complete boolean, query_tool string"
    d = lambda role, position: (role, "c", None, None, None, position)
    good = [("A", "1", "1", [d("Dimension", 1), d("Attribute", None)], True, "q"), ("", "2", None, [], None, ""), ("A", "3", "1", [d("TimeDimension", 1)], False, "p")]
    row = s.structure_summary(spark.createDataFrame(good, kind)).first()
    assert tuple(row) == (3, 2, 3, 2, True, True, 1, 2, ["p", "q"])
    for bad, field in ((d("Dimension", None), "order_preserved"), (d(None, None), "roles_preserved")):
        assert not s.structure_summary(spark.createDataFrame([*good, ("A", "4", "1", [bad], True, "q")], kind)).first()[field]
    empty = s.structure_summary(spark.createDataFrame([], kind)).first()
    assert (empty.structures, empty.order_preserved, empty.roles_preserved, empty.query_tools) == (0, False, False, [])
