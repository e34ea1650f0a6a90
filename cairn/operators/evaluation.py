"""Retrieval quality, run scores and telemetry."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.text import search_tokens
from cairn.functions.values import mean, mean_or_null, ratio
from cairn.operators.index import WEIGHTS, search_fields
from cairn.scratch import broadcast_if

#: Ranks at which recall and gain are measured, and by which an alternative must appear.
CUTOFFS, EXPOSED_BY = (1, 3, 5, 10), 5


class Suite:
    """Queries as a matrix: which of the suite's terms each one has."""

    #: Most rows of records that are held against the queries at once, and queries a matrix.
    ROWS, QUERIES = 512, 512

    def __init__(self, queries: list[tuple[object, list[str]]]) -> None:
        self.ids = [q for q, _ in queries]
        self.terms = pa.array(sorted({t for _, ts in queries for t in ts}), pa.string())
        places = {t: k for k, t in enumerate(self.terms.to_pylist())}
        self.has = [np.array(sorted({places[t] for t in ts}), np.int64) for _, ts in queries]

    def blocks(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first query, the terms that a block's queries have, queries by those terms)."""
        for first in range(0, len(self.has), self.QUERIES):
            own = self.has[first : first + self.QUERIES]
            used = np.unique(np.concatenate([*own, np.zeros(0, np.int64)]))
            wanted = np.zeros((len(own), len(used)), np.float32)
            for k, terms in enumerate(own):
                wanted[k, np.searchsorted(used, terms)] = 1
            yield first, used, wanted

    def weights(self, fields: list[tuple[int, pa.ListArray]], rows: int) -> np.ndarray:
        """Records by terms: the sum of weights of the fields that hold a term."""
        out = np.zeros((rows, len(self.terms)), np.float32)
        for weight, lists in fields:
            at = pc.index_in(lists.flatten(), value_set=self.terms)
            row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
            known = at.is_valid().to_numpy(zero_copy_only=False)
            np.add.at(out, (row[known], at.drop_null().to_numpy(zero_copy_only=False)), weight)  # once a field, but for rows that were put together
        return out


def best_of(suite: Suite, weights: list[int], depth: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best rows of a task for each query: (query, matched, score, low, id). Batches hold id, low and one list of tokens for each weight."""
    blocks = list(suite.blocks())
    best: list[list[tuple[int, int, bool, str, bool, str]]] = [[] for _ in suite.ids]
    least = np.zeros((len(suite.ids), 2), np.float32)  # matched and score that a row must reach
    size = max(16, min(suite.ROWS, (1 << 24) // (len(suite.terms) + 1)))
    for batch in (b.slice(k, size) for b in batches for k in range(0, b.num_rows, size)):
        held = suite.weights([(w, batch.column(2 + k)) for k, w in enumerate(weights)], batch.num_rows)
        for first, used, wanted in blocks:
            own = held[:, used]
            matched, score = (own > 0).astype(np.float32) @ wanted.T, own @ wanted.T
            m, s = least[first : first + len(wanted)].T
            rows, queries = np.nonzero((matched > 0) & ((matched > m) | ((matched == m) & (score >= s))))
            if not len(rows):
                continue
            low, ids = batch.column(1).take(pa.array(rows)).to_pylist(), batch.column(0).take(pa.array(rows)).to_pylist()
            for q, x, y, name, key in zip((first + queries).tolist(), matched[rows, queries].tolist(), score[rows, queries].tolist(), low, ids, strict=True):
                best[q].append((-int(x), -int(y), name is not None, name or "", key is not None, key or ""))
            for q in np.unique(first + queries).tolist():
                best[q] = sorted(best[q])[:depth]
                if len(best[q]) == depth:
                    least[q] = -best[q][-1][0], -best[q][-1][1]
    found = [(q, -m, -s, low if there else None, key if known else None) for q, rows in enumerate(best) for m, s, there, low, known, key in rows]
    columns = zip(*found, strict=True) if found else [()] * 5
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string())
    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["q", "matched", "score", "low", "id"])


def run(records: DataFrame, suite: DataFrame, depth: int = 10) -> DataFrame:
    """(query_id, id, rank): the best records for each query of a suite, by distinct terms, then weights, then title and id.

    The suite is a parameter that every task has whole. Records are scored where they are read, and each task hands on its best rows of each query alone.
    """
    spark = records.sparkSession
    rows = suite.groupBy("query_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")).orderBy("query_id").collect()  # the suite's size
    queries = Suite([(r["query_id"], [t for t in r["terms"] or [] if t is not None]) for r in rows])
    shared, fields = spark.sparkContext.broadcast(queries), search_fields()
    weights = [WEIGHTS[f] for f in fields]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return best_of(shared.value, weights, depth, batches)

    tokens = [search_tokens(F.coalesce(c, F.lit(""))).alias(f"t{k}") for k, c in enumerate(fields.values())]
    each = records.select("id", F.lower("title").alias("low"), *tokens)
    twice = each.groupBy("id", "low").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("id").alias("_id"), F.col("low").alias("_low"))
    twice = broadcast_if(twice, 200_000)  # a record that is given twice counts once, with the weights of both
    same = F.col("id").eqNullSafe(F.col("_id")) & F.col("low").eqNullSafe(F.col("_low"))
    whole = each.join(twice, same, "left_semi").groupBy("id", "low").agg(*(F.flatten(F.collect_list(f"t{k}")).alias(f"t{k}") for k in range(len(weights))))
    hits = each.join(twice, same, "left_anti").unionByName(whole).mapInArrow(task, "q int, matched int, score bigint, low string, id string")
    best = Window.partitionBy("q").orderBy(F.desc("matched"), F.desc("score"), "low", "id")
    top = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= depth)
    names = spark.createDataFrame([(k, q) for k, q in enumerate(queries.ids)], f"q int, query_id {suite.schema['query_id'].dataType.simpleString()}")
    return top.join(F.broadcast(names), "q").select("query_id", "id", "rank")


def gain(grade: Column, rank: Column) -> Column:
    return (F.pow(F.lit(2.0), grade) - 1) / F.log2(rank + 1.0)


def per_query(qrels: DataFrame, ranks: DataFrame) -> DataFrame:
    """Recall, reciprocal ranks and normalised gain of each query with relevant records; a query without results scores zero.

    ``qrels``: (query_id, id, grade, target, alternative).
    """
    ideal = Window.partitionBy("query_id").orderBy(F.desc("grade"), "id")
    judged = qrels.withColumn("ideal", F.row_number().over(ideal)).join(ranks, ["query_id", "id"], "left")
    aggregates = [F.count(F.lit(1)).alias("relevant"), F.min("rank").alias("first"), F.min(F.when(F.col("target"), F.col("rank"))).alias("target_rank")]
    for k in CUTOFFS:
        aggregates += [
            F.count_if(F.col("rank") <= k).alias(f"hits_{k}"),
            F.sum(F.when(F.col("rank") <= k, gain(F.col("grade"), F.col("rank")))).alias(f"dcg_{k}"),
            F.sum(F.when(F.col("ideal") <= k, gain(F.col("grade"), F.col("ideal")))).alias(f"best_{k}"),
        ]
    aggregates += [F.count_if("alternative").alias("alternatives"), F.count_if(F.col("alternative") & (F.col("rank") <= EXPOSED_BY)).alias("exposed")]
    got = judged.groupBy("query_id").agg(*aggregates)
    reciprocal = lambda c: F.coalesce(F.round(1 / F.col(c), 6), F.lit(0.0))
    recalls = [ratio(F.col(f"hits_{k}"), F.col("relevant")).alias(f"recall_{k}") for k in CUTOFFS]
    ndcg = [F.when(F.col(f"best_{k}") > 0, F.round(F.coalesce(F.col(f"dcg_{k}"), F.lit(0.0)) / F.col(f"best_{k}"), 6)).otherwise(1.0).alias(f"ndcg_{k}") for k in CUTOFFS]
    return got.select("query_id", "relevant", *recalls, reciprocal("first").alias("mrr"), reciprocal("target_rank").alias("primary_mrr"), *ndcg, "alternatives", "exposed")


def macro(metrics: DataFrame) -> DataFrame:
    """Means over queries, and the share of all alternatives that were exposed."""
    names = [c for c in metrics.columns if c.startswith(("recall", "mrr", "primary", "ndcg"))]
    return metrics.agg(F.count(F.lit(1)).alias("queries"), *(mean(F.col(c)).alias(c) for c in names), ratio(F.sum("exposed"), F.sum("alternatives")).alias("exposure"))


def component_means(runs: DataFrame, components: dict[str, tuple[Column, Column]], eligible: Column) -> DataFrame:
    """(component, mean, denominator) over eligible runs to which it applies; null where there are none. components: (score, applies) by name."""
    own = F.array(*(F.struct(F.lit(k).alias("component"), F.when(applies, score.cast("double")).alias("score")) for k, (score, applies) in components.items()))
    rows = runs.where(eligible).select(F.explode(own).alias("c")).select("c.*")
    return rows.groupBy("component").agg(mean_or_null(F.col("score")).alias("mean"), F.count("score").alias("denominator"))


def by_each(runs: DataFrame, dimensions: list[str], score: Column, eligible: Column) -> DataFrame:
    """One grouping for each dimension by itself: (dimension, value, runs, eligible_runs, mean)."""
    own = F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions))
    rows = runs.select(F.explode(own).alias("d"), eligible.alias("ok"), score.alias("score")).select("d.*", "ok", "score")
    return rows.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("runs"), F.count_if("ok").alias("eligible_runs"), mean_or_null(F.when(F.col("ok"), F.col("score"))).alias("mean"))


def summary(rows: DataFrame, by: str, value: str) -> DataFrame:
    return rows.groupBy(by).agg(F.count(value).alias("n"), mean_or_null(F.col(value)).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"))


def cells(rows: DataFrame, by: list[str], arm: str, required: list[str]) -> DataFrame:
    """Cells of a comparison: complete if every required arm has a run. Arms are counted as they are few, never listed by run."""
    has = [F.max((F.col(arm) == a).cast("int")) for a in required]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("runs"), F.countDistinct(arm).alias("arms"), (reduce(lambda a, b: a + b, has) == len(required)).alias("complete"))


def failures(rows: DataFrame, codes: Column, issues: DataFrame) -> DataFrame:
    """(code, n, issues): how often each failure code occurs and the ids of the issues that name it. issues: (issue, code)."""
    counts = rows.select(F.explode(codes).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    named = issues.groupBy("code").agg(F.array_join(F.array_sort(F.collect_set("issue")), ",").alias("issues"))
    return counts.join(broadcast_if(named, 20_000, cheap=True), "code", "left")


#: Components that must be whole for a selection to count as safe and exact.
STRICT = (
    "target_record", "native_id", "source_surface", "edition", "version", "hydration", "caveat_fidelity", "substitution_integrity", "assessment_present", "unsupported_claim_safety",
)
#: Components that ask whether the answer's value is one of those expected: (field of the answer, field of the expectation).
MEMBERS = {
    "target_record": ("chosen_record_id", "acceptable_record_ids"), "native_id": ("chosen_native_id", "acceptable_native_ids"), "source_surface": ("chosen_source_surface", "acceptable_source_surfaces"),
    "edition": ("chosen_edition", "acceptable_editions"), "version": ("chosen_version", "acceptable_versions"), "hydration": ("hydration_status", "allowed_hydration_statuses"),
}
#: Components that ask how many of what is expected was given.
COVERED = {
    "alternative_exposure": ("alternative_ids", "required_alternative_ids"), "contrast_coverage": ("contrast_fields", "required_contrast_fields"),
    "caveat_fidelity": ("caveat_ids", "required_caveat_ids"), "evidence_coverage": ("evidence_kinds", "required_evidence_kinds"),
}


def eligibility(runs: DataFrame) -> DataFrame:
    """Runs with the reason that keeps each from counting: at all, for validation, and for comparison; null where none does."""
    some = lambda c: F.size(c) > 0
    profile, enforced = F.col("fault_profile").isNotNull(), F.col("constraint_enforcement")
    reason = (
        F.when(some("access_violations"), "arm-violation").when(some("constraint_violations"), "constraint-violation").when(profile & ~enforced.isin("enforced", "observed"), "constraints-not-evidenced")
        .when(F.col("status").isin("blocked", "not-run"), F.concat(F.lit("readiness-"), "status"))
    )
    out = runs.withColumn("exclusion_reason", reason)
    validation = F.coalesce("exclusion_reason", F.when(F.col("arm_enforcement") != "enforced", "arm-not-enforced").when(profile & (enforced != "enforced"), "constraints-not-enforced"))
    out = out.withColumn("validation_exclusion_reason", validation)
    return out.withColumn("comparative_exclusion_reason", F.coalesce("validation_exclusion_reason", F.when(F.col("capture_fidelity") == "fixture-replay", "fixture-replay")))


def membership(actual: Column, expected: Column) -> Column:
    """1 or 0; null, not applicable, where nothing is expected."""
    return F.when(F.size(expected) > 0, F.coalesce(F.array_contains(expected, actual), F.lit(False)).cast("double"))


def covered(actual: Column, expected: Column) -> Column:
    """Share of what is expected, to six digits; null where nothing is."""
    wanted = F.array_distinct(expected)
    return F.when(F.size(expected) > 0, F.round(F.size(F.array_intersect(wanted, actual)) / F.size(wanted), 6))


def mcp_plan() -> Column:
    """1 if a plan is asked for and is the one expected: its identity, exactly its arguments, no credentials, enough unknown dimensions, not run, and evidence of that."""
    plan, wanted = F.col("plan"), F.col("expected_plan")
    same = lambda *names: reduce(lambda a, b: a & b, (F.coalesce(plan[n] == wanted[n], F.lit(False)) for n in names))
    entries = lambda m: F.array_sort(F.map_entries(m))
    secret = F.size(F.array_intersect(F.transform(F.map_keys(plan["arguments"]), lambda k: F.lower(k)), F.array(*map(F.lit, ("api_key", "apikey", "authorization", "password", "token"))))) > 0
    unknown = (F.size(plan["unknown_dimensions"]) >= wanted["minimum_unknown_dimensions"]) & F.forall(plan["unknown_dimensions"], lambda d: F.coalesce(F.trim(d) != "", F.lit(False)))
    passed = same("source", "record_id", "inspection_tool", "query_tool", "complete", "executed") & (entries(plan["arguments"]) == entries(wanted["arguments"])) & ~secret & unknown & (plan["query_tool_calls"] == 0)
    return F.when(F.col("mcp_plan_required"), F.coalesce(passed, F.lit(False)).cast("double"))


def score_runs(runs: DataFrame, expected: DataFrame) -> DataFrame:
    """Each run with its eligibility, ``components`` (name to score, those that don't apply left out), whether the selection was safe and exact (null where none is asked for), and whether all components pass.

    Runs without an answer or an assessment score 0 on what applies to them. ``expected`` has a row for each task; runs of unknown tasks are left out.
    """
    both = eligibility(runs).join(broadcast_if(expected, 20_000, cheap=True), "task_id")
    answered, assessed = F.col("answer").isNotNull(), F.col("assessment").isNotNull()
    none = F.array().cast("array<string>")
    scores = {"structured_output": answered.cast("double"), "assessment_present": assessed.cast("double")}
    scores |= {name: membership(F.col(f"answer.{a}"), F.col(e)) for name, (a, e) in MEMBERS.items()}
    given = {"alternative_ids": "answer", "contrast_fields": "answer", "caveat_ids": "assessment", "evidence_kinds": "assessment"}
    scores |= {name: covered(F.coalesce(F.col(f"{given[a]}.{a}"), none), F.col(e)) for name, (a, e) in COVERED.items()}
    scores["mcp_plan"] = mcp_plan()
    used, disclosed, policy = (F.coalesce("answer.substitution_used", F.lit(False)), F.coalesce("answer.substitution_disclosed", F.lit(False)), F.col("substitution_policy"))
    scores["substitution_integrity"] = F.when(policy == "forbidden", (~used).cast("double")).when(policy == "disclose-or-abstain", (~used | disclosed).cast("double"))
    scores["unsupported_claim_safety"] = (assessed & (F.coalesce("assessment.critical_claims", F.lit(0)) == 0)).cast("double")
    components = F.map_filter(F.create_map(*(x for k, v in scores.items() for x in (F.lit(k), v))), lambda _, v: v.isNotNull())
    out = both.withColumn("components", components)
    whole = F.forall(F.map_values("components"), lambda x: x == 1)
    strict = F.forall(F.map_values(F.map_filter("components", lambda k, _: k.isin(*STRICT))), lambda x: x == 1)
    eligible = F.col("exclusion_reason").isNull()
    return out.withColumns({"safe_exact_selection": F.when(F.size("acceptable_record_ids") > 0, (eligible & strict).cast("double")), "all_pass": eligible & whole})


def aggregated(scores: DataFrame, reason: str, *by: str) -> DataFrame:
    """(…, component, mean, denominator) over runs that no ``reason`` keeps out; the safe and exact selection counts as a component."""
    every = F.map_concat("components", F.map_filter(F.create_map(F.lit("safe_exact_selection"), "safe_exact_selection"), lambda _, v: v.isNotNull()))
    rows = scores.where(F.col(reason).isNull()).select(*by, F.explode(every).alias("component", "score"))
    return rows.groupBy(*by, "component").agg(mean_or_null(F.col("score")).alias("mean"), F.count("score").alias("denominator"))


def coverage(required: DataFrame, shown: DataFrame) -> DataFrame:
    """(query_id, required, present, share): fields that queries ask for and that results show. required: (query_id, id, field); shown: (query_id, id, field) with a value.

    Queries that ask for nothing have no row; a share of nothing would be one.
    """
    both = required.join(shown.distinct().withColumn("there", F.lit(True)), ["query_id", "id", "field"], "left")
    out = both.groupBy("query_id").agg(F.count(F.lit(1)).alias("required"), F.count("there").alias("present"))
    return out.withColumn("share", ratio(F.col("present"), F.col("required")))
