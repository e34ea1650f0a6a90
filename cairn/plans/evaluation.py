"""Queries over retrieval quality, runs and telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.text import search_tokens
from cairn.functions.values import has_value
from cairn.operators import evaluation as ev
from cairn.operators.index import WEIGHTS
from cairn.plans import sql
from cairn.plans.registry import query
from cairn.plans.search import FIELDS_SQL
from cairn.scratch import broadcast_if, materialize
from cairn.sources.records import records, table


def suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query for each benchmark passage: its search tokens."""
    rows = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("passage"))
    return rows.withColumn("terms", search_tokens(F.col("passage")))


def spaced(text: Column) -> Column:
    """Letters and digits with one space between words and at both ends."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), F.lit(" "))


def qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage's words in a row, graded by their label.

    A document is tested, in the row where it is read, only against passages whose rarest word it holds: no text is shuffled. Every task holds the suite.
    """
    own = suite(spark, sf_dir).select("query_id", spaced(F.col("passage")).alias("passage")).where("passage <> '  '")
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("documents:"), F.col("doc_id").cast("string")).alias("id"), "doc_id", spaced(F.col("text")).alias("text"))
    words = lambda c: F.explode(F.array_distinct(F.split(F.trim(c), " "))).alias("word")
    wanted = own.select("query_id", words("passage"))
    often = docs.select(words("text")).join(broadcast_if(wanted.select("word").distinct(), 200_000), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    rarest = wanted.join(often, "word").groupBy("query_id").agg(F.min(F.struct("n", "word")).alias("r")).select("query_id", F.col("r.word").alias("word"))
    near = docs.select("*", words("text")).join(F.broadcast(materialize(rarest.join(own, "query_id"), "rarest")), "word")
    held = materialize(near.where(F.contains("text", "passage")).select("query_id", "id", "doc_id"), "held")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    graded = held.join(labels, "doc_id", "left").select("query_id", "id", F.when(F.col("quality") == 1, 3).when(F.col("quality") == 0, 1).otherwise(2).alias("grade"))
    first = graded.groupBy("query_id").agg(F.min(F.struct((-F.col("grade")).alias("g"), "id")).alias("b")).select("query_id", F.col("b.id").alias("best"))
    both = graded.join(first, "query_id")
    return both.select("query_id", "id", "grade", (F.col("id") == F.col("best")).alias("target"), (F.col("id") != F.col("best")).alias("alternative"))


def ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.run(records(spark, sf_dir, "documents"), suite(spark, sf_dir))


FIELDS = " UNION ALL ".join(f"SELECT id, title, {WEIGHTS[f]} AS w, unnest({sql.tokens(f'coalesce({x}, {chr(39) * 2})')}) AS token FROM r" for f, x in FIELDS_SQL.items())
SPACED_SQL = "' ' || trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) || ' '"
IR_SQL = f"""WITH {sql.records("documents")}, f AS ({FIELDS}), q AS (SELECT item_id AS query_id, text AS passage, unnest({sql.tokens("text")}) AS token FROM benchmark),
s AS (SELECT query_id, id, title, count(DISTINCT token) AS matched, sum(w) AS score FROM f JOIN q USING (token) GROUP BY query_id, id, title),
ranks AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY matched DESC, score DESC, lower(title), id) AS rank FROM s QUALIFY rank <= 10),
g AS (SELECT item_id AS query_id, 'documents:' || doc_id AS id, CASE quality WHEN 1 THEN 3 WHEN 0 THEN 1 ELSE 2 END AS grade FROM (SELECT doc_id, {SPACED_SQL} AS t FROM documents) d JOIN (SELECT item_id, {SPACED_SQL} AS t FROM benchmark) b ON b.t <> '  ' AND contains(d.t, b.t) LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id)),
j AS (SELECT g.*, row_number() OVER (PARTITION BY query_id ORDER BY grade DESC, id) AS ideal, rank FROM g LEFT JOIN ranks USING (query_id, id)),
m AS (SELECT query_id, count(*) AS relevant, {", ".join(f"round(count(*) FILTER (rank <= {k}) / count(*), 6) AS recall_{k}" for k in ev.CUTOFFS)},
 coalesce(round(1 / min(rank), 6), 0) AS mrr, coalesce(round(1 / min(rank) FILTER (ideal = 1), 6), 0) AS primary_mrr,
 {", ".join(f"round(coalesce(sum((pow(2, grade) - 1) / log2(rank + 1)) FILTER (rank <= {k}), 0) / sum((pow(2, grade) - 1) / log2(ideal + 1)) FILTER (ideal <= {k}), 6) AS ndcg_{k}" for k in ev.CUTOFFS)},
 count(*) FILTER (ideal > 1) AS alternatives, count(*) FILTER (ideal > 1 AND rank <= 5) AS exposed FROM j GROUP BY query_id)"""


@query(IR_SQL + " SELECT * FROM m")
def ir_metrics_per_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.per_query(qrels(spark, sf_dir), ranks(spark, sf_dir))


NAMES = [f"recall_{k}" for k in ev.CUTOFFS] + ["mrr", "primary_mrr"] + [f"ndcg_{k}" for k in ev.CUTOFFS]


@query(IR_SQL + f" SELECT count(*) AS queries, {', '.join(f'coalesce(round(avg({c}), 6), 0) AS {c}' for c in NAMES)}, CASE WHEN sum(alternatives) > 0 THEN round(sum(exposed) / sum(alternatives), 6) ELSE 1 END AS exposure FROM m")
def ir_metrics_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.macro(ir_metrics_per_query(spark, sf_dir))


@query(IR_SQL + " SELECT query_id, id, rank, coalesce(rank <= 5, false) AS exposed FROM j WHERE ideal > 1")
def alternative_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = qrels(spark, sf_dir).where("alternative").join(ranks(spark, sf_dir), ["query_id", "id"], "left")
    return own.select("query_id", "id", F.col("rank").cast("long").alias("rank"), F.coalesce(F.col("rank") <= ev.EXPOSED_BY, F.lit(False)).alias("exposed"))


@query(IR_SQL + " SELECT query_id, id, rank FROM ranks")
def ir_baseline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks(spark, sf_dir).withColumn("rank", F.col("rank").cast("long"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as evaluation runs: the kind of event is the arm, the user's group the client, the time of day the delivery."""
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"), F.col("event_type").alias("arm"), (F.col("user_id") % 7).alias("client"), (F.col("user_id") % 11).alias("task"),
        F.when(F.hour("ts") < 12, "am").otherwise("pm").alias("mode"), "value", k.alias("k"),
    )


RUNS_SQL = "WITH t AS (SELECT event_id AS run_id, event_type AS arm, user_id % 7 AS client, user_id % 11 AS task, CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS mode, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)"


@query(RUNS_SQL + """, c AS (SELECT 'value' AS component, CASE WHEN k % 2 = 0 THEN least(value / 100, 1) END AS score FROM t WHERE run_id % 3 <> 0 UNION ALL SELECT 'small', CASE WHEN true THEN CAST(value < 20 AS INTEGER) END FROM t WHERE run_id % 3 <> 0 UNION ALL SELECT 'never', NULL FROM t WHERE run_id % 3 <> 0)
SELECT component, round(avg(score), 6) AS mean, count(score) AS denominator FROM c GROUP BY component""")
def run_component_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    components = {
        "value": (F.least(F.col("value") / 100, F.lit(1.0)), F.col("k") % 2 == 0), "small": ((F.col("value") < 20).cast("int"), F.lit(True)), "never": (F.lit(0.0), F.lit(False)),
    }
    return ev.component_means(runs(spark, sf_dir), components, F.col("run_id") % 3 != 0)


@query(RUNS_SQL + ", e AS (" + " UNION ALL ".join(f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, run_id % 3 <> 0 AS ok, t.value AS score FROM t" for d in ("arm", "client", "task", "mode")) + ") SELECT dimension, value, count(*) AS runs, count(*) FILTER (ok) AS eligible_runs, round(avg(score) FILTER (ok), 6) AS mean FROM e GROUP BY ALL")
def run_groupings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.by_each(runs(spark, sf_dir), ["arm", "client", "task", "mode"], F.col("value"), F.col("run_id") % 3 != 0)


@query(RUNS_SQL + " SELECT arm, count(value) AS n, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high FROM t GROUP BY arm")
def telemetry_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.summary(runs(spark, sf_dir), "arm", "value")


ARMS = ["click", "error", "purchase", "signup", "view"]


@query(RUNS_SQL + f" SELECT client, task, mode, k, count(*) AS runs, count(DISTINCT arm) AS arms, count(DISTINCT arm) FILTER (arm IN ({', '.join(repr(a) for a in ARMS)})) = {len(ARMS)} AS complete FROM t GROUP BY client, task, mode, k")
def telemetry_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.cells(runs(spark, sf_dir), ["client", "task", "mode", "k"], "arm", ARMS)


ISSUES = [("slow", "F0"), ("late", "F0"), ("wrong", "F1"), ("lost", "F2")]


@query(RUNS_SQL + f", i AS (SELECT code, string_agg(issue, ',' ORDER BY issue) AS issues FROM (VALUES {', '.join(f'({a!r}, {b!r})' for a, b in ISSUES)}) AS x(issue, code) GROUP BY code), f AS (SELECT unnest(['F' || (k % 4), 'F' || (run_id % 3)]) AS code FROM t WHERE arm = 'error') SELECT code, count(*) AS n, any_value(issues) AS issues FROM f LEFT JOIN i USING (code) GROUP BY code")
def failure_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = spark.createDataFrame(ISSUES, "issue string, code string")
    codes = F.array(F.concat(F.lit("F"), (F.col("k") % 4).cast("string")), F.concat(F.lit("F"), (F.col("run_id") % 3).cast("string")))
    return ev.failures(runs(spark, sf_dir).where("arm = 'error'"), codes, issues)



#: Expectations of eleven tasks and, of each run, what is made of its number. Both engines take these expressions.
N = "event_id"
ARRAYS = {
    "acceptable_record_ids": "CASE WHEN task_id = 3 THEN '' ELSE concat('r', CAST(task_id AS STRING), ',r', CAST(task_id + 1 AS STRING)) END", "acceptable_native_ids": "concat('n', CAST(task_id AS STRING))",
    "acceptable_source_surfaces": "CASE WHEN task_id % 2 = 0 THEN 'a,b' ELSE 'a' END", "acceptable_editions": "CASE WHEN task_id % 3 = 0 THEN '' ELSE 'e1' END", "acceptable_versions": "''", "allowed_hydration_statuses": "'whole,partial'",
    "required_alternative_ids": "CASE WHEN task_id % 4 = 0 THEN '' ELSE 'x1,x2,x3' END", "required_contrast_fields": "'unit,measure'", "required_caveat_ids": "CASE WHEN task_id % 5 = 0 THEN 'c1,c2' ELSE '' END", "required_evidence_kinds": "'k1'",
}
POLICY = "CASE task_id % 3 WHEN 0 THEN 'not-applicable' WHEN 1 THEN 'forbidden' ELSE 'disclose-or-abstain' END"
ANSWER = {
    "chosen_record_id": f"concat('r', CAST({N} % 11 + {N} % 3 AS STRING))", "chosen_native_id": f"CASE WHEN {N} % 4 = 0 THEN NULL ELSE concat('n', CAST({N} % 11 AS STRING)) END", "chosen_source_surface": f"CASE WHEN {N} % 5 = 0 THEN 'b' ELSE 'a' END",
    "chosen_edition": f"concat('e', CAST({N} % 2 AS STRING))", "chosen_version": "'v'", "hydration_status": f"CASE WHEN {N} % 7 = 0 THEN 'none' ELSE 'whole' END",
}
GIVEN = {"alternative_ids": f"CASE {N} % 3 WHEN 0 THEN 'x1,x2,x3' WHEN 1 THEN 'x2,y' ELSE '' END", "contrast_fields": f"CASE WHEN {N} % 2 = 0 THEN 'unit,measure' ELSE 'unit' END"}
ASSESSED = {"caveat_ids": f"CASE WHEN {N} % 2 = 0 THEN 'c2,c1' ELSE 'c1' END", "evidence_kinds": f"CASE WHEN {N} % 6 = 0 THEN '' ELSE 'k1,k2' END"}
HAS_ANSWER, HAS_ASSESSMENT = f"{N} % 13 <> 0", f"{N} % 17 <> 0"
USED, DISCLOSED, CLAIMS = f"{N} % 3 = 1", f"{N} % 2 = 0", f"CASE WHEN {N} % 9 = 0 THEN 1 ELSE 0 END"
RUN = {
    "status": f"CASE {N} % 19 WHEN 0 THEN 'blocked' WHEN 1 THEN 'not-run' WHEN 2 THEN 'failed' ELSE 'completed' END", "fault_profile": f"CASE WHEN {N} % 5 = 0 THEN 'slow' END",
    "constraint_enforcement": f"CASE {N} % 4 WHEN 0 THEN 'enforced' WHEN 1 THEN 'observed' ELSE 'declared' END", "arm_enforcement": f"CASE WHEN {N} % 8 = 0 THEN 'declared' ELSE 'enforced' END", "capture_fidelity": f"CASE WHEN {N} % 6 = 0 THEN 'fixture-replay' ELSE 'native' END",
}
ACCESS, CONSTRAINTS = f"CASE WHEN {N} % 23 = 0 THEN 'v' ELSE '' END", f"CASE WHEN {N} % 29 = 0 THEN 'w' ELSE '' END"
PLAN_DEFECT = f"{N} % 12"


def parted(expression: str) -> Column:
    return F.filter(F.split(F.expr(expression), ","), lambda x: x != "")


def expectations(spark: SparkSession) -> DataFrame:
    own = spark.range(11).select(F.col("id").alias("task_id"))
    plan = F.struct(
        F.lit("s").alias("source"), F.concat(F.lit("r"), F.col("task_id").cast("string")).alias("record_id"), F.lit("i").alias("inspection_tool"), F.lit("q").alias("query_tool"), F.lit(False).alias("complete"), F.lit(False).alias("executed"),
        F.create_map(F.lit("dataset"), F.lit("d"), F.lit("format"), F.lit("f")).alias("arguments"), F.lit(1).alias("minimum_unknown_dimensions"),
    )
    return own.select("task_id", *(parted(v).alias(k) for k, v in ARRAYS.items()), F.expr(POLICY).alias("substitution_policy"), (F.col("task_id") % 2 == 1).alias("mcp_plan_required"), plan.alias("expected_plan"))


def harness_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as runs of eleven tasks, with answers, assessments, plans and defects by their number."""
    answer = F.struct(*(F.expr(v).alias(k) for k, v in ANSWER.items()), *(parted(v).alias(k) for k, v in GIVEN.items()), F.expr(USED).alias("substitution_used"), F.expr(DISCLOSED).alias("substitution_disclosed"))
    assessment = F.struct(*(parted(v).alias(k) for k, v in ASSESSED.items()), F.expr(CLAIMS).alias("critical_claims"))
    is_ = lambda n: F.expr(PLAN_DEFECT) == n
    arguments = F.create_map(F.lit("dataset"), F.when(is_(2), "other").otherwise("d"), F.lit("format"), F.lit("f"))
    plan = F.struct(
        F.when(is_(1), "t").otherwise("s").alias("source"), F.concat(F.lit("r"), (F.col(N) % 11).cast("string")).alias("record_id"), F.lit("i").alias("inspection_tool"), F.lit("q").alias("query_tool"), is_(3).alias("complete"), is_(4).alias("executed"),
        F.when(is_(5), F.map_concat(arguments, F.create_map(F.lit("API_Key"), F.lit("k")))).otherwise(arguments).alias("arguments"),
        F.when(is_(6), F.array().cast("array<string>")).when(is_(7), F.array(F.lit(" "))).otherwise(F.array(F.lit("time"))).alias("unknown_dimensions"), is_(8).cast("int").alias("query_tool_calls"),
    )
    return table(spark, sf_dir, "events").select(
        F.col(N).alias("run_id"), (F.col(N) % 11).alias("task_id"), F.col("event_type").alias("arm"), *(F.expr(v).alias(k) for k, v in RUN.items()), parted(ACCESS).alias("access_violations"), parted(CONSTRAINTS).alias("constraint_violations"),
        F.when(F.expr(HAS_ANSWER), answer).alias("answer"), F.when(F.expr(HAS_ASSESSMENT), assessment).alias("assessment"), F.when(F.expr(HAS_ANSWER) & ~is_(9), plan).alias("plan"),
    )


def member_sql(actual: str, expected: str) -> str:
    return f"CASE WHEN {expected} <> '' THEN CAST(coalesce(list_contains(string_split({expected}, ','), CASE WHEN {HAS_ANSWER} THEN {actual} END), false) AS DOUBLE) END"


def covered_sql(actual: str, expected: str, there: str) -> str:
    return f"CASE WHEN {expected} <> '' THEN round(len(list_intersect(string_split({expected}, ','), CASE WHEN {there} THEN string_split({actual}, ',') ELSE [] END)) / len(string_split({expected}, ',')), 6) END"


COMPONENTS_SQL = {
    "structured_output": f"CAST({HAS_ANSWER} AS DOUBLE)", "assessment_present": f"CAST({HAS_ASSESSMENT} AS DOUBLE)", **{k: member_sql(ANSWER[a], f"({ARRAYS[e]})") for k, (a, e) in ev.MEMBERS.items()},
    **{k: covered_sql((GIVEN | ASSESSED)[a], f"({ARRAYS[e]})", HAS_ANSWER if a in GIVEN else HAS_ASSESSMENT) for k, (a, e) in ev.COVERED.items()},
    "mcp_plan": f"CASE WHEN task_id % 2 = 1 THEN CAST({HAS_ANSWER} AND {PLAN_DEFECT} IN (0, 10, 11) AS DOUBLE) END",
    "substitution_integrity": f"CASE task_id % 3 WHEN 1 THEN CAST(NOT ({HAS_ANSWER} AND {USED}) AS DOUBLE) WHEN 2 THEN CAST(NOT ({HAS_ANSWER} AND {USED}) OR ({DISCLOSED}) AS DOUBLE) END",
    "unsupported_claim_safety": f"CAST({HAS_ASSESSMENT} AND ({CLAIMS}) = 0 AS DOUBLE)",
}
REASON_SQL = f"CASE WHEN ({ACCESS}) <> '' THEN 'arm-violation' WHEN ({CONSTRAINTS}) <> '' THEN 'constraint-violation' WHEN ({RUN['fault_profile']}) IS NOT NULL AND ({RUN['constraint_enforcement']}) = 'declared' THEN 'constraints-not-evidenced' WHEN ({RUN['status']}) IN ('blocked', 'not-run') THEN 'readiness-' || ({RUN['status']}) END"
SCORED_SQL = (
    f"WITH e AS (SELECT event_id, event_type AS arm, event_id % 11 AS task_id FROM events), c AS (SELECT event_id, arm, task_id, {', '.join(f'{v} AS {k}' for k, v in COMPONENTS_SQL.items())}, {REASON_SQL} AS reason FROM e),"
    f" v AS (SELECT *, coalesce(reason, CASE WHEN ({RUN['arm_enforcement']}) <> 'enforced' THEN 'arm-not-enforced' WHEN ({RUN['fault_profile']}) IS NOT NULL AND ({RUN['constraint_enforcement']}) <> 'enforced' THEN 'constraints-not-enforced' END) AS validation FROM c),"
    f" w AS (SELECT *, coalesce(validation, CASE WHEN ({RUN['capture_fidelity']}) = 'fixture-replay' THEN 'fixture-replay' END) AS comparative, CASE WHEN task_id <> 3 THEN CAST(reason IS NULL AND {' AND '.join(f'coalesce({k}, 1) = 1' for k in ev.STRICT)} AS DOUBLE) END AS safe_exact_selection FROM v)"
)


@query(SCORED_SQL + f" SELECT event_id AS run_id, reason AS exclusion_reason, validation AS validation_exclusion_reason, comparative AS comparative_exclusion_reason, safe_exact_selection, reason IS NULL AND {' AND '.join(f'coalesce({k}, 1) = 1' for k in COMPONENTS_SQL)} AS all_pass, {', '.join(COMPONENTS_SQL)} FROM w")
def run_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fifteen components of each run, its three levels of eligibility and the strict selection."""
    scored = ev.score_runs(harness_runs(spark, sf_dir), expectations(spark))
    reasons = [f"{x}exclusion_reason" for x in ("", "validation_", "comparative_")]
    return scored.select("run_id", *reasons, "safe_exact_selection", "all_pass", *(F.try_element_at("components", F.lit(k)).alias(k) for k in COMPONENTS_SQL))


@query(
    SCORED_SQL + " SELECT arm, component, round(avg(score), 6) AS mean, count(score) AS denominator FROM (" + " UNION ALL ".join(f"SELECT arm, '{k}' AS component, {k} AS score FROM w WHERE comparative IS NULL AND {k} IS NOT NULL" for k in (*COMPONENTS_SQL, "safe_exact_selection")) + ") GROUP BY arm, component"
)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of the components over runs fit for comparison, by arm."""
    return ev.aggregated(ev.score_runs(harness_runs(spark, sf_dir), expectations(spark)), "comparative_exclusion_reason", "arm")


#: Fields that a query's alternatives are to be told apart by, and that its best document is to give evidence of.
CONTRAST, EVIDENCE = ("publisher_title", "state", "license_id"), ("notes", "state", "url")


def filled(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> DataFrame:
    """(id, field) of documents' fields with a value."""
    own = records(spark, sf_dir, "documents")
    return own.select("id", F.explode(F.filter(F.array(*(F.when(has_value(F.col(n), own.schema[n].dataType), F.lit(n)) for n in names)), F.isnotnull)).alias("field"))


def coverage_sql(names: tuple[str, ...], which: str) -> str:
    there = " OR ".join(f"(x.field = '{n}' AND coalesce(trim(r.{n}) <> '', false))" for n in names)
    values = ", ".join(f"('{n}')" for n in names)
    return f"""SELECT query_id, count(*) AS required, count(*) FILTER (rank <= 5 AND ({there})) AS present, round(count(*) FILTER (rank <= 5 AND ({there})) / count(*), 6) AS share
    FROM j JOIN r USING (id), (VALUES {values}) AS x(field) WHERE ideal {which} 1 GROUP BY query_id"""


def fields_of(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return rows.select("query_id", "id", F.explode(F.array(*map(F.lit, names))).alias("field"))


@query(IR_SQL + " " + coverage_sql(CONTRAST, ">"))
def contrast_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that tell alternatives apart, as far as the alternatives are exposed and have a value."""
    wanted = qrels(spark, sf_dir).where("alternative").select("query_id", "id")
    shown = ranks(spark, sf_dir).where(F.col("rank") <= ev.EXPOSED_BY).join(filled(spark, sf_dir, CONTRAST), "id").select("query_id", "id", "field")
    return ev.coverage(fields_of(wanted, CONTRAST), shown)


@query(IR_SQL + " " + coverage_sql(EVIDENCE, "="))
def evidence_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence that the best document of each query gives, if it is exposed."""
    wanted = qrels(spark, sf_dir).where("target").select("query_id", "id")
    shown = ranks(spark, sf_dir).where(F.col("rank") <= ev.EXPOSED_BY).join(filled(spark, sf_dir, EVIDENCE), "id").select("query_id", "id", "field")
    return ev.coverage(fields_of(wanted, EVIDENCE), shown)
