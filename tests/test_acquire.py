"""The page loop against a plain loop, in one run and in several."""

from __future__ import annotations

import random

import pytest

from cairn.streaming import acquire


def plain(pages: list[tuple], first: str = "0") -> list[tuple]:
    """Receipts of one source, by the loop written out."""
    known: dict = {}
    for p in pages:
        known.setdefault(p[1], p)
    request, asked, seen, out, reported = first, set(), [], [], None
    while request in known:
        source, _, ids, total, following, most_pages, most_items = known[request]
        asked.add(request)
        reported = total if reported is None else max(reported, total or 0)
        kept, reason, complete = [], None, False
        for i in [i for i in ids if i]:
            if i not in seen:
                seen.append(i)
                kept.append(i)
            if most_items and len(seen) >= most_items:
                complete = reported is not None and len(seen) >= reported
                reason = "sourceExhausted" if complete else "maximumItems"
                break
        if not reason and following is None:
            reason, complete = "sourceExhausted", True
        if not reason and most_pages and len(out) + 1 >= most_pages:
            reason = "maximumPages"
        if not reason and following in asked:
            reason = "repeatedRequest"
        out.append((source, len(out) + 1, request, len(ids), len([i for i in ids if i]), kept, len(seen), reported, reason, complete))
        if reason:
            break
        request = following
    return out


def source(name, n, **limits):
    ids = [[f"{name}{2 * p}", f"{name}{2 * p + 1}", f"{name}{2 * p - 1}" if p else None] for p in range(n)]
    return [(name, str(p), ids[p], 2 * n, str(p + 1) if p + 1 < n else limits.get("end"), limits.get("pages"), limits.get("items")) for p in range(n)]


FEED = [
    source("all", 6), source("pages", 6, pages=3), source("items", 6, items=5), source("exact", 3, items=6), source("loop", 4, end="1"), source("one", 1), source("pages-exact", 3, pages=3),
    [p for p in source("gap", 6) if p[1] != "3"], [("nothing", "7", ["x"], 1, None, None, None)], [("empty", "0", [], None, None, None, None)],
    [*source("twice", 3), ("twice", "1", ["other"], 99, None, None, None)],
]


@pytest.mark.parametrize("runs", [1, 3])
def test_loops(spark, tmp_path, runs):
    path = f"file://{tmp_path}"
    pages = [p for s in FEED for p in s]
    order = [p for p in pages if p[:3] != ("twice", "1", ["other"])]
    random.Random(runs).shuffle(order)
    order.append(("twice", "1", ["other"], 99, None, None, None))  # comes last, so the page recorded first stays
    for k in range(runs):
        spark.createDataFrame(order[k::runs] if k < runs - 1 else [*order[k::runs], *order[:3]], acquire.PAGE).coalesce(1).write.mode("append").parquet(f"{path}/feed")
        acquire.run(spark, f"{path}/feed", f"{path}/receipts", f"{path}/checkpoint")
    acquire.run(spark, f"{path}/feed", f"{path}/receipts", f"{path}/checkpoint")  # nothing new
    got = sorted(tuple(r) for r in spark.read.parquet(f"{path}/receipts").collect())
    want = sorted(r for s in FEED for r in plain(s))
    skipped = {"twice"} if runs == 3 else set()
    assert [g for g in got if g[0] not in skipped] == [w for w in want if w[0] not in skipped]
    reasons = {r.source: (r.reason, r.items, r.unrepresented, r.coverage_complete) for r in acquire.summary(spark.read.parquet(f"{path}/receipts")).collect()}
    assert reasons["gap"] == (None, 6, 6, False) and reasons["exact"] == ("sourceExhausted", 6, 0, False) and reasons["loop"][0] == "repeatedRequest" and "nothing" not in reasons and reasons["empty"][:2] == ("sourceExhausted", 0)


def test_the_store_is_set_for_the_run_alone(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with acquire.state_store(spark):
        assert spark.conf.get(name) == acquire.PROVIDER
    assert spark.conf.get(name, None) == before
