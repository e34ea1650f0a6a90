"""Queries over metadata evidence and gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.text import evidence_band
from cairn.functions.values import rate
from cairn.operators import gaps
from cairn.plans import sql
from cairn.plans.registry import query
from cairn.sources.records import corpus, corpus_order, records, table


def some(c: str) -> str:
    return f"coalesce({c} <> '', false)"


EVIDENCE_SQL = dict.fromkeys(gaps.SLOTS, "false") | {
    "identity": "true", "description": some("notes"), "publisher": some("publisher_title"), "licence": some("license_id"), "population": some("population_type"),
    "geography": "len(area_served) > 0", "quality_documentation": "len(quality_notes) > 0", "revision_status": some("state"), "provenance": some("url"),
}
SCORE_SQL = "round((" + " + ".join(f"CAST({v} AS INTEGER)" for v in EVIDENCE_SQL.values()) + ") / 14.0, 3)"


def long_sql(keep: str, source: str = "r") -> str:
    return " UNION ALL ".join(f"SELECT {keep}, '{k}' AS field, {v} AS present FROM {source}" for k, v in EVIDENCE_SQL.items())


RATE_SQL = "CASE WHEN count(*) > 0 THEN round(count(*) FILTER (present) / count(*), 6) ELSE 0 END"
COUNTS_SQL = f"count(*) FILTER (present) AS present, count(*) AS possible, count(*) FILTER (NOT present) AS missing, {RATE_SQL} AS completeness"
RULES = [("parts", "population"), ("parts", "time_coverage"), ("suppliers", "population")]
RULES_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in RULES) + ") AS x(source_surface, field)"


@query(f"WITH {sql.records()} SELECT id, {', '.join(f'{v} AS {k}' for k, v in EVIDENCE_SQL.items())}, {SCORE_SQL} AS score FROM r")
def evidence_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("id", *(v.alias(k) for k, v in gaps.evidence().items()), gaps.evidence_score().alias("score"))


@query(f"WITH {sql.records()} SELECT source_surface, CASE WHEN {SCORE_SQL} >= 0.8 THEN 'high' WHEN {SCORE_SQL} >= 0.55 THEN 'medium' ELSE 'low' END AS band, {SCORE_SQL} AS score, count(*) AS n FROM r GROUP BY ALL")
def evidence_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = records(spark, sf_dir).select("source_surface", gaps.evidence_score().alias("score"))
    return own.groupBy("source_surface", evidence_band(F.col("score")).alias("band"), "score").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {sql.records()}, e AS ({long_sql('source_surface')}) SELECT field, {COUNTS_SQL} FROM e GROUP BY field")
def gap_profile_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.profile(gaps.long_evidence(records(spark, sf_dir)), "field")


@query(f"WITH {sql.records()}, e AS ({long_sql('source_surface')}) SELECT source_surface, field, {COUNTS_SQL} FROM e GROUP BY source_surface, field")
def gap_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.profile(gaps.long_evidence(records(spark, sf_dir), "source_surface"), "source_surface", "field")


@query(f"WITH {sql.records()}, e AS ({long_sql('source_surface')}) SELECT {COUNTS_SQL}, count(*) FILTER (NOT present) // 2 AS half_gap FROM e")
def gap_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.profile(gaps.long_evidence(records(spark, sf_dir))).withColumn("half_gap", F.floor(F.col("missing") / 2))


@query(
    f"WITH {sql.corpus()}, e AS ({long_sql('ordinal, id', 'c')}), m AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY ordinal) AS n FROM e WHERE NOT present) SELECT field, string_agg(id, ',' ORDER BY ordinal) AS samples FROM m WHERE n <= 5 GROUP BY field"
)
def gap_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five records, in corpus order, that lack each kind of evidence."""
    from pyspark.sql import Window

    rows = gaps.long_evidence(corpus(spark, sf_dir), "ordinal", "id").where("NOT present")
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("field").orderBy("ordinal"))).where("n <= 5")
    ids = F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "id"))), lambda x: x["id"])
    return first.groupBy("field").agg(F.array_join(ids, ",").alias("samples"))


def states_sql(by: str) -> str:
    counts = ", ".join(f"count(*) FILTER (state = '{s}') AS {s.replace('-', '_')}" for s in gaps.STATES)
    return f"""WITH {sql.records()}, e AS ({long_sql('source_surface')}),
    s AS (SELECT e.*, CASE WHEN present THEN 'present' WHEN x.field IS NOT NULL THEN 'not-applicable' ELSE 'not-evidenced' END AS state FROM e LEFT JOIN {RULES_SQL} ON x.source_surface = e.source_surface AND x.field = e.field)
    SELECT {by}, {counts}, count(*) AS possible, count(*) FILTER (state <> 'not-applicable') AS applicable_possible FROM s GROUP BY {by}"""


def applicable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "source_surface string, field string")
    return gaps.states(gaps.long_evidence(records(spark, sf_dir), "source_surface"), rules)


@query(states_sql("field"))
def applicability_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.state_counts(applicable(spark, sf_dir), "field")


@query(states_sql("source_surface"))
def applicability_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.state_counts(applicable(spark, sf_dir), "source_surface")


HALVES = "1996-01-01"


@query(
    f"""WITH e AS (SELECT o_orderdate < TIMESTAMP '{HALVES}' AS early, unnest([{{'field': 'urgent', 'present': o_orderpriority LIKE '1%'}}, {{'field': 'finished', 'present': o_orderstatus = 'F'}}, {{'field': 'large', 'present': o_totalprice > 100000}}]) AS x FROM orders),
    p AS (SELECT early, x.field AS field, count(*) FILTER (x.present) AS present, count(*) AS possible, count(*) FILTER (NOT x.present) AS missing, round(count(*) FILTER (x.present) / count(*), 6) AS completeness FROM e GROUP BY ALL)
    SELECT a.field, a.present - b.present AS added, a.missing AS remaining, round((a.completeness - b.completeness) * 100, 4) AS points, CASE WHEN b.missing > 0 THEN round((a.present - b.present) / b.missing, 6) ELSE 0 END AS gap_closed
    FROM p a JOIN p b ON a.field = b.field AND NOT a.early AND b.early"""
)
def profile_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of three properties of orders before and after a date, compared."""
    slots = {"urgent": F.col("o_orderpriority").startswith("1"), "finished": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 100_000}
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("field"), v.alias("present")) for k, v in slots.items())))
    rows = table(spark, sf_dir, "orders").select((F.col("o_orderdate") < F.lit(HALVES).cast("timestamp")).alias("early"), each.alias("e")).select("early", "e.*")
    both = gaps.profile(rows, "early", "field")
    return gaps.delta(both.where("early"), both.where("NOT early"), "field")


@query(
    f"WITH {sql.records()}, v AS (SELECT id, unnest([native_id, record_type, publisher_title, url, license_id, state]) AS x FROM r) SELECT count(*) FILTER (x IS NOT NULL AND x <> '') AS present, count(*) AS possible, count(*) FILTER (x IS NULL OR x = '') AS missing, round(count(*) FILTER (x IS NOT NULL AND x <> '') / count(*), 6) AS completeness FROM v"
)
def provenance_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness over the values, at most fourteen, of each record's provenance map."""
    names = ("native_id", "record_type", "publisher_title", "url", "license_id", "state")
    values = F.slice(F.map_values(F.create_map(*(x for n in names for x in (F.lit(n), F.col(n))))), 1, 14)
    rows = records(spark, sf_dir).select(F.explode(values).alias("x")).select(F.coalesce(F.col("x") != "", F.lit(False)).alias("present"))
    return rows.agg(F.count_if("present").alias("present"), F.count(F.lit(1)).alias("possible"), F.count_if(~F.col("present")).alias("missing")).withColumn("completeness", rate(F.col("present"), F.col("possible")))
