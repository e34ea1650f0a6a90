"""Queries over structure definitions: one for each order, with its lines as components, and code lists for each supplier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.plans.registry import query
from cairn.sources import structures
from cairn.sources.records import table

KIND = "CASE l_linenumber % 5 WHEN 1 THEN 'Dimension' WHEN 2 THEN ' TimeDimension ' WHEN 3 THEN 'attribute' WHEN 4 THEN 'PrimaryMeasure' ELSE 'group' END"


def defined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, components): lines of an order, of which every third part declares a position."""
    line = F.struct(
        "l_linenumber", F.expr(KIND).alias("kind"), F.concat(F.lit("c"), F.col("l_partkey").cast("string")).alias("concept"), F.when(F.col("l_suppkey") % 2 == 0, "").otherwise("CL").alias("codeList"),
        F.lit(None).cast("string").alias("attachmentLevel"), F.lit("").alias("assignmentStatus"), F.when(F.col("l_partkey") % 3 == 0, F.col("l_partkey")).cast("int").alias("position"),
    )
    own = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(line)).alias("raw"))
    raw = F.transform("raw", lambda c: F.struct(*(c[x] for x in ("kind", "concept", "codeList", "attachmentLevel", "assignmentStatus", "position"))))
    return own.select("o_orderkey", structures.components(raw).alias("components"))


COMPONENTS_SQL = f"""c AS (SELECT l_orderkey AS o_orderkey, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp, 'c' || l_partkey AS concept, l_suppkey % 2 <> 0 AS code, lower(trim({KIND})) AS kind FROM lineitem),
d AS (SELECT *, count(*) FILTER (kind IN ('dimension', 'timedimension')) OVER (PARTITION BY o_orderkey ORDER BY line, concept, code, part ROWS UNBOUNDED PRECEDING) AS n FROM c), k AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY line, concept, code) - 1 AS place FROM d WHERE kind <> 'group')"""


@query(
    f"""WITH {COMPONENTS_SQL} SELECT o_orderkey, CAST(place AS INTEGER) AS place, CASE kind WHEN 'dimension' THEN 'Dimension' WHEN 'timedimension' THEN 'TimeDimension' WHEN 'attribute' THEN 'Attribute' ELSE 'PrimaryMeasure' END AS role, concept,
    CASE WHEN supp % 2 <> 0 THEN 'CL' END AS code_list, CASE WHEN kind IN ('dimension', 'timedimension') THEN CAST(CASE WHEN part % 3 = 0 THEN part ELSE n END AS INTEGER) END AS position FROM k"""
)
def structure_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = defined(spark, sf_dir).select("o_orderkey", F.posexplode("components").alias("place", "c"))
    return own.select("o_orderkey", "place", "c.role", "c.concept", F.col("c.codeList").alias("code_list"), "c.position")


@query(
    """SELECT count(*) AS structures, count(*) FILTER (o_orderkey % 5 <> 0) AS agencies, count(*) AS identifiers, count(*) FILTER (o_orderkey % 3 <> 0) AS versions, true AS order_preserved, true AS roles_preserved, count(*) FILTER (o_orderkey % 7 = 0) AS complete,
    count(*) FILTER (o_orderkey % 7 <> 0) AS incomplete, 'nomis_query,other' AS query_tools FROM (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem)"""
)
def structure_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    own = defined(spark, sf_dir).select(
        F.when(k % 5 != 0, "agency").alias("agency"), k.cast("string").alias("identifier"), F.when(k % 3 == 0, "").otherwise("1.0").alias("version"), "components", F.when(k % 7 == 0, True).when(k % 7 == 1, False).alias("complete"),
        F.when(k % 4 == 0, "").when(k % 4 == 1, "other").otherwise("nomis_query").alias("query_tool"),
    )
    return structures.structure_summary(own).withColumn("query_tools", F.array_join("query_tools", ","))


S = "s_suppkey"


def codelists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code lists of suppliers: frequencies of one or two codes, years or months of which the last isn't out, one that occurs twice or has another form."""
    k = F.col(S)
    code = lambda value, label, status=None: F.struct(value.alias("value"), label.alias("label"), (status if status is not None else F.lit(None).cast("string")).alias("revisionStatus"))
    text = lambda x: F.lit(x)
    frequency = F.when(k % 4 == 0, F.array(code(text("A"), text("<i>Annual</i>")))).when(k % 4 == 1, F.array(code(text("A"), text("Annual")), code(text("M"), text("monthly")))).when(k % 4 == 2, F.array(code(text("X"), text("N/A")))).otherwise(F.array(code(text("Q"), text("")), code(text("Q"), text("Quarterly"))))
    value = lambda i: F.when(k % 3 == 0, F.format_string("200%d-%02d", (i % 2).cast("int"), (i + 1).cast("int"))).otherwise((2000 + i).cast("string"))
    last = (k % 6 + 1).cast("int")
    periods = F.transform(F.sequence(F.lit(0), last), lambda i: code(value(i), F.concat(F.lit("in "), value(i), F.when((i == last) & (k % 5 == 1), " (not yet released)").otherwise("")), F.when((i == last) & (k % 5 == 0), "Pre-Release")))
    odd = F.when(k % 11 == 2, F.array(code(text("2000"), text("again")))).when(k % 11 == 3, F.array(code(text("2001 Q1"), text("a quarter")))).otherwise(F.array().cast("array<struct<value: string, label: string, revisionStatus: string>>"))
    one = lambda concept, name, status, reason, codes: F.struct(text(concept).alias("concept"), text(name).alias("codeList"), status.alias("status"), text(reason).alias("reason"), codes.alias("codes"))
    lists = F.array(
        one("time", "CL_OLD", text("present"), "", F.array(code(text("1900"), text("old")))), one("Freq", "CL_FREQ", F.when(k % 13 == 5, "absent").otherwise("Present"), "", frequency), one("TIME", "CL_TIME", F.when(k % 13 == 6, "not-evidenced").otherwise(""), "no list", F.concat(periods, odd)),
        one("GEO", "CL_GEO", text(""), "", periods),
    ).cast(structures.CODELISTS)
    return table(spark, sf_dir, "supplier").select(S, lists.alias("lists"))


CODES_SQL = f"""p AS (SELECT {S}, s_suppkey % 6 + 1 AS last, unnest(range(0, s_suppkey % 6 + 2)) AS i FROM supplier WHERE {S} % 13 <> 6),
v AS (SELECT {S}, i, CASE WHEN {S} % 3 = 0 THEN format('200{{}}-{{:02d}}', i % 2, i + 1) ELSE CAST(2000 + i AS VARCHAR) END AS value, i = last AND {S} % 5 IN (0, 1) AS shut, '' AS odd FROM p
 UNION ALL SELECT {S}, 99, CASE WHEN {S} % 11 = 2 THEN '2000' ELSE '2001 Q1' END, false, CASE WHEN {S} % 11 = 2 THEN 'again' ELSE 'a quarter' END FROM supplier WHERE {S} % 11 IN (2, 3) AND {S} % 13 <> 6),
t AS (SELECT {S}, count(*) AS codes, count(*) FILTER (NOT shut) AS available, count(DISTINCT value) FILTER (NOT shut) AS kinds, min(value) FILTER (NOT shut) AS low, max(value) FILTER (NOT shut) AS high,
 CASE WHEN bool_and(shut OR regexp_full_match(value, '[12][0-9]{{3}}')) THEN 'YYYY' WHEN bool_and(shut OR regexp_full_match(value, '[12][0-9]{{3}}-(0[1-9]|1[0-2])')) THEN 'YYYY-MM' END AS form FROM v GROUP BY {S})"""


@query(
    f"""WITH {CODES_SQL} SELECT {S}, CASE WHEN {S} % 13 = 5 THEN NULL WHEN {S} % 4 = 0 THEN 'Annual' WHEN {S} % 4 = 3 THEN 'Quarterly' END AS frequency, CASE WHEN {S} % 13 = 5 THEN NULL WHEN {S} % 4 = 0 THEN 'Annual' WHEN {S} % 4 = 1 THEN 'Annual,monthly' WHEN {S} % 4 = 2 THEN '' ELSE 'Quarterly' END AS labels,
    coalesce(t.codes, 1)::INTEGER AS codes, coalesce(t.available, 1)::INTEGER AS available, CASE WHEN t.codes IS NULL THEN 'YYYY' ELSE t.form END AS period_format, CASE WHEN t.codes IS NULL THEN '1900' WHEN form IS NOT NULL AND kinds = t.available THEN low END AS start, CASE WHEN t.codes IS NULL THEN '1900' WHEN form IS NOT NULL AND kinds = t.available THEN high END AS "end",
    CASE WHEN t.codes IS NULL THEN 'TIME CL_TIME no list' ELSE '' END AS without FROM supplier LEFT JOIN t USING ({S})"""
)
def codelist_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequencies and periods that code lists evidence without doubt."""
    own = structures.codelist_evidence(codelists(spark, sf_dir), "lists")
    without = F.array_join(F.transform("not_evidenced", lambda x: F.concat_ws(" ", x["concept"], x["code_list"], x["reason"])), ";")
    return own.select(S, "frequency_evidence.frequency", F.array_join("frequency_evidence.labels", ",").alias("labels"), "time_evidence.codes", "time_evidence.available", "time_evidence.period_format", "time_evidence.start", "time_evidence.end", without.alias("without"))


@query(
    """WITH d AS (SELECT l_orderkey AS o_orderkey, l_linenumber AS line, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE 'd' || l_partkey % 3 END AS id, CASE WHEN l_partkey % 7 = 1 THEN 'Geography' WHEN l_partkey % 5 = 0 THEN NULL ELSE 'n' END AS name,
    CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_linenumber % 2 = 0 END AS area, CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_partkey END AS options FROM lineitem),
    f AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey, coalesce(id, ''), coalesce(name, '') ORDER BY line, options NULLS FIRST) AS nth FROM d WHERE id IS NOT NULL OR name IS NOT NULL)
    SELECT o_orderkey, count(*)::INTEGER AS dimensions, string_agg(coalesce(id, '') || '/' || coalesce(name, ''), ',' ORDER BY line, id NULLS FIRST, name NULLS FIRST) AS names, coalesce(string_agg(coalesce(id, '') || '/' || coalesce(name, ''), ',' ORDER BY line, id NULLS FIRST, name NULLS FIRST) FILTER (coalesce(area, false) OR lower(name) = 'geography'), '') AS areas, coalesce(sum(options), 0)::BIGINT AS options FROM f WHERE nth = 1 GROUP BY o_orderkey"""
)
def version_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions of versions, one for each line of an order, and those of them that are areas."""
    part = F.col("l_partkey")
    d = F.struct(
        "l_linenumber", F.when(part % 5 != 0, F.concat(F.lit(" d"), (part % 3).cast("string"))).alias("id"), F.when(part % 7 == 1, "<b>Geography</b>").when(part % 5 != 0, "n").alias("name"), F.lit("").alias("label"), F.lit("about").alias("description"),
        F.lit("https://h.example/d").alias("href"), F.when(F.col("l_linenumber") % 4 != 0, F.col("l_linenumber") % 2 == 0).alias("is_area_type"), F.when(part % 9 == 0, -1).otherwise(part).cast("bigint").alias("number_of_options"),
    )
    each = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", structures.version_dimension(d).alias("x"))
    kept = F.struct("l_linenumber", *(F.col(f"x.{c}").alias(c) for c in ("id", "name", "label", "is_area_type", "number_of_options")))
    own = each.groupBy("o_orderkey").agg(F.slice(F.sort_array(F.collect_list(kept)), 1, structures.MOST_DIMENSIONS).alias("every"))
    own = own.select("o_orderkey", structures.first_named(F.col("every")).alias("d")).where(F.size("d") > 0)
    names = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws("/", F.coalesce(x["id"], F.lit("")), F.coalesce(x["name"], F.lit("")))), ",")
    options = F.aggregate("d", F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x["number_of_options"], F.lit(0)))
    return own.select("o_orderkey", F.size("d").alias("dimensions"), names(F.col("d")).alias("names"), names(structures.area_dimensions(F.col("d"))).alias("areas"), options.alias("options"))
