"""What callers ask of a catalogue: search, hydrate, compare and plan, as functions that return tables, and typed refusals."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators import index
from cairn.operators.identity import KEYS, identities, lookup

OUTCOMES = ("NOT_FOUND", "AMBIGUOUS", "INVALID_ARGUMENT", "BINDING_PLANNED", "REQUIRES_LIVE_INSPECTION", "PROHIBITED_INPUT")
#: Argument names that must not be passed.
FORBIDDEN = (
    "access_token", "api_key", "apikey", "authorization", "bearer", "chain_of_thought", "credential", "credentials", "hidden_reasoning", "observation", "observation_values", "observations", "password",
    "private_reasoning", "reasoning", "secret", "secrets", "thoughts",
)
#: Patterns of text that callers must not pass.
PROHIBITED = {
    "bearer": r"(?i)\bbearer\s+[a-z0-9._~+/=-]{12,}",
    "key": r"\bsk-[A-Za-z0-9_-]{12,}",
    "access_key": r"\bAKIA[A-Z0-9]{16}\b",
    "repository_token": r"\bgh[pousr]_[A-Za-z0-9]{20,}\b",
    "map_key": r"\bAIza[A-Za-z0-9_-]{30,}\b",
    "home_path": r"(?i)(?:/Users/|/Volumes/|[A-Z]:\\\\Users\\\\)",
}


class Refused(ValueError):
    """A request that ends with one of the outcome codes."""

    def __init__(self, code: str, message: str) -> None:
        super().__init__(f"{code}: {message}")
        self.code = code


def guard(value: object) -> None:
    """Refuse arguments with forbidden names or content that looks like a secret."""
    if isinstance(value, Mapping):
        for k, v in value.items():
            if re.sub(r"[^a-z]+", "_", str(k).lower()).strip("_") in FORBIDDEN:
                raise Refused("PROHIBITED_INPUT", f"argument {k!r} isn't accepted")
            guard(v)
    elif isinstance(value, (list, tuple)):
        for v in value:
            guard(v)
    elif isinstance(value, str) and any(re.search(p, value) for p in PROHIBITED.values()):
        raise Refused("PROHIBITED_INPUT", "the input looks like a secret")


def refusals(names: Column, text: Column) -> Column:
    """Why requests are refused, as ``guard`` does one by one: forbidden argument names and kinds of prohibited text, sorted."""
    plain = F.transform(names, lambda n: F.btrim(F.regexp_replace(F.lower(n), "[^a-z]+", "_"), F.lit("_")))
    forbidden = F.array_intersect(plain, F.array(*map(F.lit, FORBIDDEN)))
    kinds = F.filter(F.array(*(F.when(text.rlike(p), F.lit(f"text:{k}")) for k, p in PROHIBITED.items())), F.isnotnull)
    return F.array_sort(F.concat(F.transform(forbidden, lambda n: F.concat(F.lit("name:"), n)), kinds))


def resolve(records: DataFrame, identifier: str) -> str:
    """The id of the one record that an identifier names; only records that hold it as one of their keys are grouped."""
    wanted = records.sparkSession.createDataFrame([(identifier,)], "wanted string")
    holders = records.where(reduce(or_, (F.lower(k) == identifier.lower() for k in KEYS)))
    found = lookup(identities(holders), wanted).first()
    if found["outcome"] != "FOUND":
        raise Refused(found["outcome"], f"no single record is {identifier!r}")
    return found["id"]


def search(records: DataFrame, query: str, source: str | None = None, limit: int = 10) -> DataFrame:
    """The record that a query names exactly, if there is one; else the best ranked."""
    guard(query)
    if not 1 <= limit <= 20:
        raise Refused("INVALID_ARGUMENT", "limit must be between 1 and 20")
    own = records if source is None else records.where(F.col("source_surface") == source)
    try:
        exact = resolve(records, query)
    except Refused:
        exact = None
    if exact is not None:
        return own.where(F.col("id") == exact).withColumns({"matched": F.lit(0), "score": F.lit(0)})
    if not index.query_tokens(query):
        raise Refused("INVALID_ARGUMENT", "the query holds no term to search for")
    return index.ranked(own, query, limit)


def with_binding(records: DataFrame, *content: str) -> DataFrame:
    """Records with ``binding_sha256``, the digest of their content (all columns, if none are named) as canonical JSON: fields in the order of their names, null ones included."""
    whole = F.to_json(F.to_variant_object(F.struct(*(content or records.columns))))
    return records.withColumn("binding_sha256", F.sha2(whole, 256))


def hydrate(records: DataFrame, identifier: str) -> DataFrame:
    """One whole record with a digest of its content."""
    return with_binding(records.where(F.col("id") == resolve(records, identifier)))


def plan(records: DataFrame, proposed: DataFrame, available: Column) -> DataFrame:
    """(id, plan_status, conflicts, plan_id) for proposed arguments: (id, arguments map).

    An argument that contradicts the record's identity makes the plan invalid; records without a binding are planned only.
    """
    fixed = F.create_map(F.lit("source"), F.col("source_surface"), F.lit("native_id"), F.col("native_id"))
    both = proposed.join(records.select("id", "source_surface", "native_id", available.alias("available")), "id")
    conflicts = F.map_filter(fixed, lambda k, v: F.coalesce(F.try_element_at("arguments", k) != v, F.lit(False)))
    both = both.withColumn("conflicts", F.array_sort(F.map_keys(conflicts)))
    status = F.when(F.size("conflicts") > 0, "invalid-identity").when(~F.col("available"), "binding-planned").otherwise("requires-live-inspection")
    text = F.concat_ws("|", "id", status, F.array_join(F.transform(F.array_sort(F.map_entries("arguments")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","))
    return both.select("id", status.alias("plan_status"), F.array_join("conflicts", ",").alias("conflicts"), F.sha2(text, 256).alias("plan_id"))


def retained(ranked: DataFrame, alternatives: DataFrame, anchors: int = 8, limit: int = 8) -> DataFrame:
    """(id, kept_for): alternatives of the first few results that aren't among the results. ranked: (id, place) of a bounded result list."""
    near = alternatives.join(F.broadcast(ranked.where(F.col("place") <= anchors)), "id").select(F.col("other"), "place", "rank", F.col("id").alias("kept_for"))
    new = near.join(F.broadcast(ranked.select(F.col("id").alias("other"))), "other", "left_anti")
    first = new.groupBy("other").agg(F.min(F.struct("place", "rank", "kept_for")).alias("b"))
    return first.orderBy("b.place", "b.rank", "other").limit(limit).select(F.col("other").alias("id"), "b.kept_for")
