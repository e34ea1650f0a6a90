"""Standards of records, and the measures of queries with known values."""

from __future__ import annotations

import pytest

from cairn.operators import standards as s

SUITE = [("Q1", "target", {"target": 3, "companion": 1}, [("alternative", 1, ["measure_concept", "denominator"])], ["title", "statistical.measure"], ["DCAT-AP", "SDMX"])]


def results(*rows):
    return [("Q1", i, n, *(given.get(x, e) for x, e in (("metadata", {}), ("contrast", {}), ("claims", [])))) for n, (i, given) in enumerate(rows, 1)]


def measured(spark, rows, cutoffs=(1, 3)):
    return s.evaluate(spark.createDataFrame(SUITE, s.SUITE), spark.createDataFrame(rows, s.RESULT), cutoffs).first()


def test_known_values(spark):
    target = {"metadata": {"title": "Target"}, "claims": [("dcat_ap", "partial", "mapping"), ("SDMX", "not-evaluated", None)]}
    got = measured(spark, results(("alternative", {"contrast": {"measure_concept": "rate", "denominator": " "}}), ("target", target), ("irrelevant", {})))
    assert (got.depth, got.target_rank, got.recall_1, got.recall_3, got.mrr, got.primary_mrr, got.ndcg_1, got.ndcg_3) == (3, 2, 0.0, 0.5, 0.5, 0.5, 0.0, 0.578764)
    assert (got.exposure, got.contrast, got.evidence, got.standards_coverage) == (1.0, 0.5, 0.5, 0.5) and (got.missing_evidence, got.missing_standards) == (["statistical.measure"], ["SDMX"])


def test_missing_query_and_perfect_run(spark):
    none = measured(spark, [])
    assert none.target_rank is None and all(none[m] == 0.0 for m in ("recall_1", "recall_3", "mrr", "primary_mrr", "ndcg_1", "ndcg_3", "exposure", "contrast", "evidence", "standards_coverage"))
    suite = [("Q1", "target", {"target": 3}, [("alternative", 5, ["a"])], ["title"], ["DCAT-AP"])]
    rows = results(("target", {"metadata": {"title": "x"}, "claims": [("DCAT AP", "aligned", "e")]}), ("alternative", {"contrast": {"a": "x"}}))
    got = s.evaluate(spark.createDataFrame(suite, s.SUITE), spark.createDataFrame(rows, s.RESULT), (1, 3)).first()
    assert got.depth == 5 and all(got[m] == 1.0 for m in ("recall_1", "recall_3", "mrr", "primary_mrr", "ndcg_1", "ndcg_3", "exposure", "contrast", "evidence", "standards_coverage"))


def test_a_target_below_the_depth_shows_nothing(spark):
    rows = results(*[(f"x{i}", {}) for i in range(3)], ("target", {"metadata": {"title": "x", "statistical.measure": "y"}}))
    got = measured(spark, rows)
    assert (got.target_rank, got.primary_mrr, got.mrr, got.evidence) == (4, 0.0, 0.0, 0.0)


@pytest.mark.parametrize(
    ("row", "statuses"),
    [
        ({"source_surface": "nomis", "dimension_count": 2, "provenance": "p", "title": "t", "url": "u"}, {"sdmx": ("aligned", True), "data-cube": ("partial", True), "prov-o": ("aligned", True), "dcat-3": ("aligned", True), "code-of-practice-3.0": ("partial", False)}),
        ({"source_surface": "other", "dimension_count": 0, "quality_notes": ["n"]}, {"sdmx": ("not-applicable", False), "data-cube": ("not-evaluated", False), "prov-o": ("partial", False), "dcat-3": ("aligned", False), "code-of-practice-3.0": ("partial", True)}),
    ],
)
def test_standards_of_records(spark, row, statuses):
    kind = "source_surface string, dimension_count int, provenance string, title string, url string, quality_notes array<string>, notes string, topics array<string>, metadata_modified string"
    names = [c.split()[0] for c in kind.split(", ")]
    got = {x.standard: (x.status, x.evidence) for x in s.with_standards(spark.createDataFrame([tuple(row.get(n) for n in names)], kind)).first().standards}
    assert {k: got[k] for k in statuses} == statuses and len(got) == 6


def test_claims_and_their_faults(spark):
    kind = "id string, title string, url string, source_surface string, metadata_modified string, provenance string, geography array<string>"
    rows = spark.createDataFrame([("1", "t", "u", "nomis", "2024", "p", ["ward"]), ("2", "t", None, "x", None, None, [])], kind)
    got = {r.id: {c.standard: (c.status, c.evidence) for c in r.claims} for r in s.with_claims(rows).collect()}
    assert got["1"] == {"DCAT-AP": ("partial", "1 t u"), "SDMX": ("aligned", "nomis"), "ISO 8601": ("partial", "2024"), "PROV-O": ("aligned", "p"), "GSS geography codes": ("partial", "ward")}
    assert got["2"] == {"DCAT-AP": ("partial", "2 t"), "SDMX": ("not-applicable", None), "ISO 8601": ("not-evaluated", None), "PROV-O": ("not-evaluated", None), "GSS geography codes": ("not-evaluated", None)}
    claims = spark.createDataFrame([(1, "DCAT-AP", "aligned", "x"), (1, "dcat_ap", "partial", "x"), (2, "SDMX", "certified", "x"), (3, "SDMX", "partial", " "), (3, "ISO", "not-evaluated", None), (4, "SDMX", None, None)], "k int, standard string, status string, evidence string")
    assert sorted(map(tuple, s.claim_faults(claims, "k").collect())) == [(1, "dcat-ap", "duplicate standard"), (2, "sdmx", "status"), (3, "sdmx", "evidence"), (4, "sdmx", "status")]


def test_summaries(spark):
    register = spark.createDataFrame([("a", "2024-01-01", ["r1", "r2"]), ("b", "", None), ("c", "2025-05-05", ["r"])], "id string, current_as_of string, requirements array<string>")
    assert tuple(s.register_summary(register).first()) == (3, 3, "2025-05-05") and tuple(s.register_summary(register.limit(0)).first()) == (0, 0, "")
    rows = spark.createDataFrame([(["m"], [], "p"), ([], ["q"], None), (None, None, "")], "methodology_links array<string>, quality_links array<string>, provenance string")
    assert tuple(s.availability(rows).first()) == (3, 1, 1, 1, 0)
