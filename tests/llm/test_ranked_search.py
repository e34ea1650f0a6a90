from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import ranked_search as r
from cairn.llm.common import words


def brute(docs: list[tuple], items: list[tuple], top: int = 10) -> list[tuple]:
    own = [(i, Counter(words(t or ""))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n_docs, n_terms = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    asked: dict = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(words(text or ""))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c in own:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, k, i, -s) for k, (s, _, _, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def ranked(spark, docs, items, segment=200, block=4, per_group=2):
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    stats = r.statistics(table)
    index = r.materialize(r.build_index(table, stats, segment_terms=segment, block=block), "index")
    return sorted((tuple(x) for x in r.search(index, spark.createDataFrame(items, "item_id long, text string"), stats, per_group=per_group).collect()), key=str)


def corpus(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    draw = lambda k: " ".join(f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(k))
    return [(i, draw(rng.choice([3, 20, 60]))) for i in range(n)]


@pytest.mark.parametrize(("segment", "block", "per_group"), [(200, 4, 2), (3000, 128, 100), (1, 1, 1)])
def test_against_brute_force(spark, segment, block, per_group):
    docs = corpus(1, 150) + [(1000, None), (1001, ""), (1002, "..."), (7, "W1 w1 w2"), (7, "W1 w1 w2"), (None, "w1 w2 w1"), (1003, "Ünïcode wörter w3 " * 300), (1004, "naïve_w3-w5")]
    items = [(1, "w1 w2 w3"), (2, "W1 W1 wörter"), (3, "none of these"), (4, None), (5, ""), (None, "w1"), (1, "w9"), (6, " ".join(f"w{i}" for i in range(400))), (8, "w1")]
    assert ranked(spark, docs, items, segment, block, per_group) == brute(docs, items)


def test_ties_by_the_least_ids(spark):
    docs = [(i, "alike words here") for i in range(40, 0, -1)] + [(100 + i, f"other{i}") for i in range(60)]
    got = ranked(spark, docs, [(1, "words")], segment=30)
    assert [x[2] for x in sorted(got, key=lambda x: x[1])] == list(range(1, 11))


def test_empty_tables_and_further_columns(spark):
    assert ranked(spark, [], [(1, "w1")]) == []
    assert ranked(spark, [(1, "w1")], []) == []
    docs = spark.createDataFrame(corpus(2, 30), "doc_id long, text string").withColumns({c: F.lit(1) for c in ("segment", "term", "df", "part", "items")})
    items = spark.createDataFrame([(1, "w1 w2")], "item_id long, text string").withColumns({c: F.lit(1) for c in ("term", "weight", "part")})
    stats = r.statistics(docs)
    got = r.search(r.build_index(docs, stats), items, stats).collect()
    assert sorted(map(tuple, got), key=str) == brute(corpus(2, 30), [(1, "w1 w2")])


def test_salted_join_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(r, "BROADCAST_ROWS", 0)
    docs = corpus(3, 80)
    assert ranked(spark, docs, [(1, "w1 w2 w7"), (2, "w3")]) == brute(docs, [(1, "w1 w2 w7"), (2, "w3")])


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    edges = np.array([0, 3, 4, 132, 140])
    gaps, values = rng.integers(0, 1 << 17, 140), rng.integers(0, 1_000_000, 140)
    gaps[edges[:-1]] = 0
    gaps[4:132] = 1
    payload, begins = r.pack(edges, gaps, values)
    for a, b, s, e in zip(edges, edges[1:], begins, begins[1:]):
        docs, got = r.unpack(memoryview(payload.tobytes()), int(s), int(e), 50)
        assert docs.tolist() == (50 + np.cumsum(gaps[a:b])).tolist() and got.tolist() == values[a:b].tolist()


def test_blocks_below_the_threshold_stay_packed():
    rng = np.random.default_rng(2)

    def postings(docs, values, weight, block=16):
        edges = np.array([*range(0, len(docs), block), len(docs)])
        gaps = np.diff(docs, prepend=0)
        gaps[edges[:-1]] = 0
        payload, begins = r.pack(edges, gaps, values)
        return r.Postings(weight, docs[edges[:-1]], docs[edges[1:] - 1], np.maximum.reduceat(values, edges[:-1]), begins[:-1], memoryview(payload.tobytes()))

    common = np.sort(rng.choice(100_000, 20_000, False))
    rare = np.sort(rng.choice(100_000, 200, False))
    terms = [(common, rng.integers(1, 1000, len(common)), 1), (rare, rng.integers(500, 1000, len(rare)), 50)]
    search = r.Search([postings(*t) for t in terms])
    docs, scores = search.best()
    sums = np.zeros(100_000, np.int64)
    for d, v, w in terms:
        sums[d] += v * w
    want = np.lexsort((np.arange(100_000), -sums))[:10]
    assert docs.tolist() == want.tolist() and scores.tolist() == sums[want].tolist()
    assert search.unpacked < len(search.firsts) / 4
