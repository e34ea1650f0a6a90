"""Metadata evidence of records, gap profiles, applicability and the difference of two profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.values import rate
from cairn.scratch import broadcast_if

#: Evidence slots, in order.
SLOTS = (
    "identity", "description", "publisher", "licence", "contact", "release_or_modified", "frequency", "population", "geography", "time_coverage", "methodology",
    "quality_documentation", "revision_status", "provenance",
)
STATES = ("present", "not-applicable", "not-evidenced", "conflicted")


def some(name: str) -> Column:
    return F.coalesce(F.col(name) != "", F.lit(False))


def evidence() -> dict[str, Column]:
    """Whether a record has each kind of evidence; a lane without the columns has none."""
    none = F.lit(False)
    return {
        "identity": some("native_id") & some("source_surface"), "description": some("notes"), "publisher": some("publisher_title"),
        "licence": some("license_id") & (F.coalesce("license_id", F.lit("")) != "not-evaluated"), "contact": none, "release_or_modified": some("metadata_modified"),
        "frequency": some("frequency"), "population": some("population_type"), "geography": F.size("area_served") > 0, "time_coverage": none,
        "methodology": F.size("methodology_links") > 0, "quality_documentation": F.size("quality_notes") > 0, "revision_status": some("state"), "provenance": some("url"),
    }


def evidence_score() -> Column:
    return F.round(sum((v.cast("int") for v in evidence().values()), F.lit(0)) / len(SLOTS), 3)


def long_evidence(records: DataFrame, *keep: str) -> DataFrame:
    """(kept columns, field, present): a row for each record and slot."""
    own = F.array(*(F.struct(F.lit(k).alias("field"), v.alias("present")) for k, v in evidence().items()))
    return records.select(*keep, F.explode(own).alias("e")).select(*keep, "e.field", "e.present")


def profile(rows: DataFrame, *by: str) -> DataFrame:
    """Present, missing and completeness of (…, present) rows."""
    out = rows.groupBy(*by).agg(F.count_if("present").alias("present"), F.count(F.lit(1)).alias("possible"))
    return out.withColumn("missing", F.col("possible") - F.col("present")).withColumn("completeness", rate(F.col("present"), F.col("possible")))


def states(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Each (source_surface, field, present) row's state; ``rules`` (source_surface, field) name slots that don't apply."""
    marked = rows.join(broadcast_if(rules.withColumn("excluded", F.lit(True)), 20_000, cheap=True), ["source_surface", "field"], "left")
    return marked.withColumn("state", F.when(F.col("present"), "present").when(F.col("excluded"), "not-applicable").otherwise("not-evidenced"))


def state_counts(rows: DataFrame, *by: str) -> DataFrame:
    counts = [F.count_if(F.col("state") == s).alias(s.replace("-", "_")) for s in STATES]
    out = rows.groupBy(*by).agg(*counts, F.count(F.lit(1)).alias("possible"))
    return out.withColumn("applicable_possible", F.col("possible") - F.col("not_applicable"))


def delta(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Change of two profiles by key: values added, still missing, share of the earlier gap closed, percentage points."""
    b = before.select(key, *(F.col(c).alias(f"before_{c}") for c in ("present", "possible", "missing", "completeness")))
    both = b.join(after, key)
    added = F.col("present") - F.col("before_present")
    return both.select(
        key, added.alias("added"), F.col("missing").alias("remaining"), F.round((F.col("completeness") - F.col("before_completeness")) * 100, 4).alias("points"),
        rate(added, F.col("before_missing")).alias("gap_closed"),
    )
