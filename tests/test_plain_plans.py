"""Scores of the browser and dimensions of versions are plain expressions over rows: no lambda looks through whole texts, nothing is worked out that nobody asks for."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.functions.text import plain_text
from cairn.operators import index
from cairn.plans.structures import version_dimensions


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_browser_scores(spark):
    rows = [("a:1", "1", "The Cat", "the cat sat", ["cat"]), ("a:2", "2", None, "THE hat", []), ("cat", "3", "dog", None, ["x"]), ("a:4", "4", "d", "e", [])]
    own = spark.createDataFrame(rows, "id string, native_id string, title string, notes string, topics array<string>").withColumns({"tags": F.array().cast("array<string>"), "context_note": F.lit(None).cast("string")})
    for text in ("the cat", " CAT the cat ", "at", "c-'", "!!", ""):
        low, want = text.strip().lower(), {}
        terms = list(dict.fromkeys(w for w in index.re.findall(r"[a-z0-9][a-z0-9'-]*", low)))
        for i, n, title, notes, topics in rows:
            fields = {"title": title or "", "identifiers": f"{i} {n}", "subjects": " ".join(topics), "description": notes or "", "context": ""}
            fields = {f: x.lower() for f, x in fields.items()}
            score = sum(w * (sum(t in fields[f] for t in terms) + (2 if len(low) > 2 and low in fields[f] else 0)) for f, w in index.BROWSER_WEIGHTS.items())
            want[i] = score + (index.BROWSER_ALL if all(any(t in x for x in fields.values()) for t in terms) else 0) if terms else 1
        found = index.browser_scored(own, text)
        assert {r["id"]: r["score"] for r in found.collect()} == want
        assert "lambda" not in plan(found)


def test_dimensions_leave_out_what_nobody_asks_for(spark):
    assert "h.example" not in plan(version_dimensions(spark, "/root/testdata/sf0.001"))


def test_plain_text_of_all_kinds(spark):
    given = {"abc": "abc", "": "", " a  b ": "a b", "a b": "a b", "a\tb\n": "a b", "a&amp;b": "a&b", "<b>x</b> y": "x y", "a\\nb": "a b", "q\\x": "q\\x", "a" * 30: "a" * 19 + "…", "&#32;x": "x"}
    rows = spark.createDataFrame([(k,) for k in given] + [(None,)], "t string").select("t", plain_text(F.col("t"), 20).alias("p")).collect()
    assert {r.t: r.p for r in rows} == given | {None: None}
