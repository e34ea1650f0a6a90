"""Alternatives: what the signatures leave out can't reach the threshold, and most candidates are left out."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from cairn.operators import profiles, relate


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def made(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(120)]
    titles = [" ".join(rng.choices(words, k=rng.choice((1, 2, 5, 20, 60)))) for _ in range(120)]
    titles += [" ".join(t.split()[: max(1, len(t.split()) * 2 // 3)]) for t in titles[:60]] + ["", None]
    rows = [(f"r{k}", t, "ab"[k % 2], [f"w{k % 7}"], ["tag"]) for k, t in enumerate(titles)]
    return spark.createDataFrame(rows, "id string, title string, source_surface string, topics array<string>, tags array<string>"), rows


def test_alternatives_equal_all_pairs(spark):
    df, rows = made(spark)
    tokens = {i: (set((t or "").split()), set((t or "").split()) | set(topics) | set(tags)) for i, t, _, topics, tags in rows}
    rare = {w for w in set().union(*(a for _, a in tokens.values())) if 2 <= sum(w in a for _, a in tokens.values()) <= relate.FREQUENT}
    want = set()
    for i, (t1, a1) in tokens.items():
        scores = {o: 0.75 * jaccard(t1, t2) + 0.25 * jaccard(a1, a2) for o, (t2, a2) in tokens.items() if o != i and a1 & a2 & rare}
        titles = {r[0]: r[1] for r in rows}
        best = sorted((o for o, s in scores.items() if s >= 0.32), key=lambda o: (-scores[o], titles[o] is not None, titles[o] or "", o))[:4]
        want |= {(i, o, n, int(scores[o] * 1000 + 0.5 + 1e-9) / 1000) for n, o in enumerate(best, 1)}
    got = {(r.id, r.other, r["rank"], r.similarity) for r in relate.alternatives(df).collect()}
    assert got == want


def test_few_candidates_go_on(spark):
    df, _ = made(spark)
    each = relate.signed(relate.tokenised(df).select("id", "title_tokens", "all_tokens"))
    pairs = each.alias("a").join(each.alias("b"), "token").where(F.col("a.id") < F.col("b.id"))
    kept = pairs.where(relate.may_reach(relate.THRESHOLD)).select("a.id", "b.id").distinct().count()
    assert kept * 4 < pairs.count()


def test_pairs_carry_no_tokens(spark):
    """Only rows that stay meet the tokens themselves: pairs are scored and ranked by hashes."""
    plan = relate.alternatives(made(spark)[0])._jdf.queryExecution().optimizedPlan().toString()
    ranked = plan[plan.index("Window [row_number") :]
    ranked = ranked[: ranked.index("Relation [")]
    assert "array_intersect" in ranked and "array_sort" not in ranked


def test_pairs_are_dealt_to_all_tasks(spark):
    """F6 to F11: postings are few bytes but make many pairs, so their shuffle may not be put together by its bytes where no side is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = relate.alternatives(made(spark)[0])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert any("Exchange hashpartitioning(token" in line and "REPARTITION_BY_NUM" in line for line in plan.splitlines())


def best_of_all(rows, limit=4):
    """(id, other, rank, similarity) by all pairs, rows being numbered, so that an id may stand for several."""
    tokens = [(set((t or "").split()), set((t or "").split()) | set(topics) | set(tags)) for _, t, _, topics, tags in rows]
    found = {}
    for (t1, a1), (i, *_) in zip(tokens, rows, strict=True):
        scored = [(0.75 * jaccard(t1, t2) + 0.25 * jaccard(a1, a2), t, o) for (t2, a2), (o, t, *_) in zip(tokens, rows, strict=True) if o != i]
        found.setdefault(i, []).extend((-s, t, o) for s, t, o in scored if s >= 0.32)
    return sorted((i, o, n, int(-s * 1000 + 0.5 + 1e-9) / 1000) for i, best in found.items() for n, (s, _, o) in enumerate(sorted(best)[:limit], 1))


def alternatives_of(spark, rows):
    df = spark.createDataFrame(rows, "id string, title string, source_surface string, topics array<string>, tags array<string>").repartition(4)
    return sorted((r.id, r.other, r["rank"], r.similarity) for r in relate.alternatives(df).collect())


def test_frequent_tokens_leave_no_alternative_out(spark):
    """F2 to F11: records that share nothing but a token of more than FREQUENT records were no candidates."""
    rows = [(f"r{k:03}", f"common n{k}" if k else "common", "ab"[k % 2], [], []) for k in range(relate.FREQUENT + 60)]
    got = alternatives_of(spark, rows)
    assert got == best_of_all(rows) and len(got) == 4 * len(rows)


def test_frequent_and_rare_tokens_together(spark, monkeypatch):
    """F2 to F11: whatever is called frequent, the best of all pairs are found, also where ids are repeated."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    rows = [(f"r{k % 290}", " ".join(rng.choices(words, weights, k=rng.choice((1, 2, 3, 8, 20)))), "ab"[k % 2], [f"w{k % 7}"], ["tag"]) for k in range(300)]
    want = best_of_all(rows)
    for few in (1, 5, 40, 200):
        monkeypatch.setattr(relate, "FREQUENT", few)
        assert alternatives_of(spark, rows) == want


def test_chunks_are_walked_whole(spark, monkeypatch):
    """F2 to F11: with chunks of a few profiles every profile still meets all."""
    monkeypatch.setattr(relate, "FREQUENT", 1)
    monkeypatch.setattr(profiles, "ASKED", 7)
    monkeypatch.setattr(profiles, "CHUNK", 5)
    rows = made(spark)[1][:150]
    assert alternatives_of(spark, rows) == best_of_all(rows)
