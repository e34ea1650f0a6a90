from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cairn.functions import evidence as e
from cairn.functions.text import bounded, plain_text, public_host, safe_public_url, slug
from cairn.functions.values import bbox_extent

T = F.lit

@pytest.fixture(scope="module")
def cases(spark):
    return build()


def build():
    return [
        (e.title_year(T("Wards 2021 and 2021")), 2021), (e.title_year(T("From 2020 to 2021")), None), (e.title_year(T("Code 120211")), None),
        (e.cadence(T("Updated annually, once quarterly")), "quarterly"), (e.cadence(T("now and then")), None),
        (e.area_served(F.array(T("UK"), T(" wales"), T("uk"), T("mars"))), ["United Kingdom", "Wales"]), (e.countries(F.array(T("e"), T("X"))), ["England"]),
        (e.version_label(T("Atlas (v2.1) of x")), "V2.1"), (e.version_label(T("Atlas")), None),
        (e.reference_date(T("Wards 2021"), T("Boundaries as at 31 December 2021.")), "31 December 2021"), (e.reference_date(T("Wards 2020"), T("as at May 2021")), None),
        (e.quality_note(T("One. See data quality and limitations here. Two.")), "See data quality and limitations here."), (e.quality_note(T("nothing")), None),
        (e.labelled_links(T("Methodology: https://a/b. Other text " + "x" * 200 + " https://c/d methodology https://e/f?token=1")), ["https://a/b"]),
        (e.markdown_links(T("[Quality report](https://q/x) [Other](https://o/y)"), e.QUALITY_LINK), ["https://q/x"]),
        (e.informative(F.array(T("/Categories/Latest/"), T("/Categories/Wards"))), ["/Categories/Wards"]), (e.subtopics(F.array(T("/Categories/Wards"))), ["Wards"]),
        (e.utc_expiry(T("2026-01-01T02:00:00+02:00")), "2026-01-01T00:00:00Z"), (e.utc_expiry(T("2026-01-01")), None),
        (F.to_json(e.period_extent(F.array(T("2001"), T("1999")), T("2020-06"))), '{"start":"1999","end":"2001"}'), (F.to_json(e.period_extent(F.array(T("2001"), T("2001-02")), T("2020-06"))), None), (F.to_json(e.period_extent(F.array(T("2020-07")), T("2020-06"))), None),
        (e.revision_note(T("One. The file was revised in May. Two.")), "The file was revised in May."), (e.revision_note(T("Figures are provisional.")), None),
        (plain_text(T("<p>a&amp;b &#233;&#x20AC; &nope; <script>x<1</script>c</p>")), "a&b é€ &nope; c"), (bounded(T("abcdef"), 4), "abc…"),
        (slug(T("  Crème & <b>Brûlée</b>!")), "cr-me-br-l-e"), (slug(T("!!")), "record"),
        (public_host(T("HTTPS://Example.COM:80/x")), "example.com"), (public_host(T("https://u:p@h/")), None), (safe_public_url(T("https://h/?a=1&token=2")), False), (safe_public_url(T("ftp://h/")), False),
        (F.to_json(bbox_extent(F.array(F.struct(T(1.0).alias("x"), T(2.0).alias("y")), F.struct(T(-3.0).alias("x"), T(5.0).alias("y"))))), '{"west":-3.0,"south":2.0,"east":1.0,"north":5.0}'),
    ]


def test_values(spark, cases):
    row = spark.range(1).select(*(c.alias(f"c{i}") for i, (c, _) in enumerate(cases))).first()
    for i, (_, want) in enumerate(cases):
        assert row[i] == want, i
