from __future__ import annotations

from cairn.llm import decontamination as d
from cairn.llm.common import words


def brute(texts: dict, items: list, window: int = 10):
    out = {}
    for i, t in texts.items():
        w = words(t or "")
        hit, names = set(), set()
        for item, text in items:
            v = words(text or "")
            if item is None or not v:
                continue
            n = min(window, len(v))
            grams = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)}
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in grams:
                    hit |= set(range(p, p + n))
                    names.add(item)
        out[i] = (len(w), len(hit), sorted(names))
    return out


def spread(row):
    return (row.n_words, sum(s["to"] - s["from"] for s in row.spans), sorted(row["items"]))


def test_against_brute_force(documents, spark, prose):
    passage, other = prose(30, 1), prose(14, 2)
    texts = [
        " ".join(prose(50, 3) + passage + prose(20, 4)), " ".join(passage[:9]), " ".join(passage[5:20]).upper(), "tiny phrase", "a tiny, phrase! ends", None, "", " ".join(other * 3),
        "the the the the", " ".join(passage) + " " + " ".join(passage),
    ]
    items = [(1, " ".join(passage)), (2, " ".join(other)), (3, "Tiny phrase"), (4, None), (5, ""), (None, "a b"), (6, "the the the the"), (1, "ends")]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = brute(dict(enumerate(texts)), items)
    for size, block in ((40, 10_000), (1_000_000, 1)):
        index = d.materialize(d.build_index(documents(texts), segment_words=size), "index")
        got = {r.doc_id: spread(r) for r in d.phrase_matches(index, table, block_words=block).collect()}
        assert got == want


def test_clean_keeps_columns_and_the_rest(documents, spark, prose):
    passage = " ".join(prose(20, 1))
    docs = documents(["x " + passage, "clean", None, ""])
    table = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = d.clean(docs, table)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 2, 3]


def test_empty_tables(documents, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    index = d.indexed(documents(["one two", None]))
    assert all(not r.spans for r in d.phrase_matches(index, none).collect())
    assert d.phrase_matches(d.indexed(documents(["x"]).limit(0)), none).count() == 0


def test_proximity(documents, spark):
    texts = ["alpha x x beta", "beta " + "x " * 30 + "alpha", "alpha beta gamma alpha", "beta alpha", None]
    queries = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    got = d.proximity_matches(d.indexed(documents(texts)), queries, slop=5).collect()
    assert sorted((r.doc_id, r["from"], r["to"]) for r in got) == [(0, 0, 4), (2, 0, 2), (2, 1, 4), (3, 0, 2)]
