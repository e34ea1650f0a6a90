from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import vector_search as v

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows: list[tuple], top: int = 20) -> dict:
    ok = []
    for i, x in rows:
        if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x) and any(x):
            ok.append((i, np.array(x, np.float32).astype(float)))
    out = {}
    for q, x in ok:
        if q % 20 == 0:
            found = sorted({(-float(np.add.accumulate(x * y)[-1]), i) for i, y in ok if i != q})[:top]
            out[q] = [(i, -s) for s, i in found]
    return out


def got(spark, rows, partitions=4, **more) -> dict:
    table = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    out: dict = {}
    for r in sorted(v.search(table, F.col("vec_id") % 20 == 0, **more).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(found: dict, want: dict) -> float:
    """Neighbours that score no less than the last true one."""
    hits = sum(sum(s >= want[q][-1][1] - 1e-12 for _, s in found.get(q, [])) for q in want)
    return hits / sum(map(len, want.values()))


def rows_of(x: np.ndarray) -> list[tuple]:
    return [(i, [float(c) for c in row]) for i, row in enumerate(x.astype(np.float32))]


def clustered(n: int, dim: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.normal(size=(40, dim))[rng.integers(0, 40, n)] + 0.3 * rng.normal(size=(n, dim))


@pytest.mark.parametrize("kind", ["clustered", "random", "norms"])
def test_recall_against_brute_force(spark, monkeypatch, kind):
    """In random vectors there is nothing to learn; with unequal norms the nearest are the long ones, not those of a query's cell."""
    monkeypatch.setattr(v, "BLOCK", 256)
    rng = np.random.default_rng(1)
    x = {"clustered": clustered(6000, 16, 2), "random": rng.normal(size=(4000, 24)), "norms": rng.normal(size=(4000, 16)) * rng.lognormal(0, 1, (4000, 1))}[kind]
    rows = rows_of(x)
    found, want = got(spark, rows), brute(rows)
    assert set(found) == set(want) and recall(found, want) >= 0.93


def test_a_walk_leaves_cells_out():
    x = clustered(6000, 16, 2)
    q = v.Quantiser(v.k_means(x[:, :8], 18, 1), v.k_means(x[:, 8:], 18, 2))
    i, j, ri, rj = q.cells(x)
    count = np.zeros((len(q.first), len(q.second)))
    np.add.at(count, (i, j), 1)
    cells = v.Cells(q, count, np.bincount(i, ri, len(q.first)) / np.maximum(count.sum(1), 1) / 8, np.bincount(j, rj, len(q.second)) / np.maximum(count.sum(0), 1) / 8)
    seen, total = 0, 0
    for query in x[:50]:
        least = np.sort(x @ query)[-21]
        reached = cells.walk(query, 0.6, least)
        place = v.ordered(q, query[None])[0]
        seen += sum(count[c, place < n].sum() for c, n in reached.items())
        total += len(x)
    assert seen < total / 3


def test_walk_takes_the_greatest_sums_first():
    rng = np.random.default_rng(3)
    q = v.Quantiser(rng.normal(size=(7, 3)), rng.normal(size=(9, 4)))
    cells = v.Cells(q, np.ones((7, 9)), np.ones(7), np.ones(9))
    x = rng.normal(size=7)
    place = v.ordered(q, x[None])[0]
    sums = (q.first @ x[:3])[:, None] + (q.second @ x[3:])[None, :]
    for n in (1, 5, 30, 63):
        reached = cells.walk(x, n)
        seen = {(i, j) for i, k in reached.items() for j in range(9) if place[j] < k}
        assert len(seen) == n and min(sums[s] for s in seen) >= max((sums[i, j] for i in range(7) for j in range(9) if (i, j) not in seen), default=-np.inf)


@pytest.mark.parametrize("partitions", [1, 7])
def test_copies_ties_and_unusable_vectors(spark, partitions):
    rng = np.random.default_rng(4)
    rows = rows_of(rng.normal(size=(300, 8)))
    same = rows[3][1]
    rows += [(1000 + i, same) for i in range(120)] + [(2000, [-0.0 if not c else c for c in same]), (2000, same)]
    rows += [(5000, None), (5020, []), (5040, [0.0] * 8), (5060, [1.0] * 7 + [None]), (5080, [float("nan")] * 8), (5100, [float("inf")] + [1.0] * 7), (None, same)]
    rows += [(6000 + i, [float(c) for c in np.eye(8)[i % 8]]) for i in range(48)]
    found, want = got(spark, rows, partitions, recall=1.0), brute(rows)
    assert found == want and 5000 not in found and 2000 in found


def test_other_dimensions_take_no_part(spark):
    rows = rows_of(np.random.default_rng(5).normal(size=(60, 6)))
    assert got(spark, rows + [(200, [1.0, 2.0]), (220, [1.0] * 9)]) == brute(rows)


def test_few_and_none(spark):
    assert got(spark, []) == {}
    assert got(spark, [(20, [1.0, 0.0])]) == {}
    assert got(spark, [(20, [1.0]), (21, [2.0]), (22, [-1.0])]) == {20: [(21, 2.0), (22, -1.0)]}


def test_further_columns(spark):
    rows = rows_of(np.random.default_rng(6).normal(size=(50, 6)))
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("key", "vec", "ids", "i", "block", "score", "label")})
    out = v.search(table, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r.vec_id) for r in out) == sorted((q, i) for q, n in brute(rows).items() for i, _ in n)
