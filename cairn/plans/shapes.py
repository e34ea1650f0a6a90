"""Queries over the shape of values, sets of keys and rules on groups. Values are made of table rows by expressions that both engines take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.functions import shapes as s
from cairn.operators import joins, validate
from cairn.operators.gaps import evidence_score
from cairn.operators.index import facet_values
from cairn.plans import sql
from cairn.plans.registry import query
from cairn.plans.search import facets_sql
from cairn.sources.records import records, table

P = "p_partkey"
CODE = f"concat(CASE {P} % 3 WHEN 0 THEN 'ts' WHEN 1 THEN 'TS' ELSE 'T' END, lpad(CAST({P} % 1000 AS STRING), 3, '0'))"
CODED = f"concat(CASE {P} % 4 WHEN 0 THEN 'KS101EW - ' WHEN 1 THEN 'ks102: ' WHEN 2 THEN 'KS103 ' ELSE '' END, p_name)"
NAME = f"CASE {P} % 3 WHEN 0 THEN 'unitOf_measure' WHEN 1 THEN 'last-updated' ELSE 'sourcePublisher title' END"
SHOUT = f"concat(' API-Key ', CAST({P} AS STRING), '!')"


@query(
    f"""SELECT {P}, array_to_string(list_sort(list_distinct(list_filter([CASE WHEN regexp_matches(upper({CODE}), '^[A-Z]{{2}}\\d{{3}}$') THEN upper({CODE}) END, CASE {P} % 4 WHEN 0 THEN 'KS101EW' WHEN 1 THEN 'KS102' END], lambda x: x IS NOT NULL))), ',') AS codes,
    CASE {P} % 3 WHEN 0 THEN 'Unit Of Measure' WHEN 1 THEN 'Last Updated' ELSE 'Source Publisher Title' END AS label, 'apikey' || {P} AS plain, 'api_key_' || {P} AS under, CASE WHEN {P} % 5 = 0 THEN 'Not evidenced in this snapshot' ELSE p_brand END AS shown FROM part"""
)
def codes_and_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "part")
    return own.select(
        P, F.array_join(s.declared_codes(F.expr(CODE), F.expr(CODED)), ",").alias("codes"), s.human_label(F.expr(NAME)).alias("label"), s.plain_key(F.expr(SHOUT)).alias("plain"), s.under_key(F.expr(SHOUT)).alias("under"),
        s.shown(F.when(F.col(P) % 5 != 0, F.col("p_brand")).otherwise("")).alias("shown"),
    )


C = "c_custkey"


@query(
    f"""SELECT {C}, CASE {C} % 3 WHEN 0 THEN 'ACME=https://a.example/;' || lower(c_mktsegment) || '=' WHEN 1 THEN 'ACME=https://a.example/' ELSE 'acme=;ACME=https://a.example/' END AS parties, CASE {C} % 4 WHEN 0 THEN 'https://h.example/x/' || {C} WHEN 1 THEN 'https://h.example/x/' || {C} || '/' END AS own_link,
    CASE WHEN {C} % 3 <> 1 THEN DATE '2024-01-01' + CAST({C} % 200 AS INTEGER) END AS window_start, CASE {C} % 3 WHEN 0 THEN 90 WHEN 1 THEN 3690 END AS elapsed FROM customer"""
)
def parties_and_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parties named twice, self links of which one alone is the record's, windows with the end before the start, and times without an offset."""
    k = F.col(C)
    party = lambda name, url: F.struct(name.alias("name"), F.lit(url).alias("url"))
    acme, low = party(F.lit(" ACME "), "https://a.example/"), party(F.lit("acme"), "https://a.example/")
    values = F.when(k % 3 == 0, F.array(low, acme, party(F.lower("c_mktsegment"), ""), party(F.lit(" "), "x"))).when(k % 3 == 1, F.array(low, acme)).otherwise(F.array(acme, party(F.lit("acme"), "")))
    link = lambda rel, href: F.struct(F.lit(rel).alias("rel"), href.alias("href"))
    here = F.concat(F.lit("https://h.example/x/"), k.cast("string"))
    links = F.when(k % 4 == 0, F.array(link("self", here), link("Self ", here), link("next", F.concat(here, F.lit("?p=2"))))).when(k % 4 == 1, F.array(link("SELF", F.concat(here, F.lit("/"))), link("self", F.lit("https://h.example/other"))))
    links = links.when(k % 4 == 2, F.array(link("self", here), link("self", F.concat(here, F.lit("/"))))).otherwise(F.array(link("self", F.concat(F.lit("ftp://h.example/"), k.cast("string")))))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 200).cast("int"))
    window = s.usage_window(day.cast("string"), F.date_add(day, F.when(k % 3 == 1, -1).otherwise(0)).cast("string"))
    end = F.when(k % 3 == 0, "2026-01-01T00:01:30Z").when(k % 3 == 1, "2026-01-01T00:01:30-01:00").otherwise("2026-01-01T00:01:30")
    return table(spark, sf_dir, "customer").select(
        C, F.array_join(F.transform(s.parties(values), lambda p: F.concat_ws("=", p["name"], p["url"])), ";").alias("parties"), s.own_link(links, k.cast("string")).alias("own_link"), window["start"].alias("window_start"),
        s.elapsed_seconds(F.lit("2026-01-01T00:00:00Z"), end).cast("int").alias("elapsed"),
    )


E_ = "event_id"


@query(
    f"""SELECT {E_}, CASE WHEN value / 100 BETWEEN 0 AND 1 THEN value / 100 END AS share, least(1.0, greatest(0.0, value / 100 - 0.25)) AS clamped, CASE {E_} % 4 WHEN 0 THEN '1.0,2.0,3.0,4.0' WHEN 1 THEN '5.0,6.0,7.0,8.0' WHEN 2 THEN '9.0,8.0,7.0,6.0' END AS box,
    CASE {E_} % 4 WHEN 0 THEN 'geo,dimension-2' WHEN 1 THEN 'Age,dimension-2' WHEN 2 THEN 'Sex,dimension-2' ELSE 'dimension-1,dimension-2' END AS dimensions, CASE {E_} % 3 WHEN 0 THEN 'b,a,c' WHEN 2 THEN '' END AS categories, 'a=' || CASE {E_} % 3 WHEN 0 THEN 'aligned' WHEN 1 THEN 'partial' ELSE 'not-evaluated' END || ';b=not-evaluated' AS claims FROM events"""
)
def numbers_and_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares and clamped numbers, first usable boxes, names of dimensions, categories in the order of their positions and known statuses."""
    k = F.col(E_)
    texts = lambda *v: F.array(*map(F.lit, v))
    box = s.first_box(F.when(k % 4 == 0, texts("1", "2", "x", "3", "4", "5")), F.when(k % 4 < 2, texts("5", "6", "7", "8")).otherwise(texts("1", "Infinity", "2", "3")), F.when(k % 4 == 2, texts("9", "8", "7", "6")))
    field = lambda n, v: F.when(k % 4 == n, v).alias(("id", "name", "label")[n])
    first = F.struct(field(0, "geo"), field(1, "Age"), field(2, "Sex"), F.lit("").alias("concept"))
    none = F.lit(None).cast("string")
    dimensions = F.array(first, F.struct(none.alias("id"), none.alias("name"), F.lit("").alias("label"), none.alias("concept")))
    positions = F.when(k % 3 == 0, F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(0), F.lit("c"), F.lit(2))).when(k % 3 == 1, F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>")))
    claims = F.create_map(F.lit("schema"), F.lit("x"), F.lit("b"), F.lit("certified"), F.lit("a"), F.when(k % 3 == 0, "Aligned").when(k % 3 == 1, "partial").otherwise("?"))
    return table(spark, sf_dir, "events").select(
        E_, s.finite_share(F.col("value") / 100).alias("share"), s.clamped(F.col("value") / 100 - 0.25).alias("clamped"), F.array_join(box.cast("array<string>"), ",").alias("box"), F.array_join(s.dimension_names(dimensions), ",").alias("dimensions"),
        F.array_join(s.ordered_categories(positions), ",").alias("categories"), F.array_join(F.transform(s.claim_statuses(claims), lambda x: F.concat_ws("=", x["standard"], x["status"])), ";").alias("claims"),
    )


@query(facets_sql() + ", n AS (SELECT facet, value, count(*) AS n FROM f WHERE value <> '__missing__' GROUP BY facet, value) SELECT facet, value, n, CAST(row_number() OVER (PARTITION BY facet ORDER BY n DESC, value) AS INTEGER) AS place FROM n QUALIFY place <= 80")
def facet_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eighty most frequent values of each facet, as a menu shows them."""
    own = facet_values(records(spark, sf_dir).withColumn("ordinal", F.lit(0)), evidence_score()).where("value <> '__missing__'")
    counts = own.groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("facet").orderBy(F.desc("n"), "value")
    return counts.withColumn("place", F.row_number().over(best)).where("place <= 80").select("facet", "value", "n", "place")


@query("SELECT (SELECT count(*) FROM (SELECT DISTINCT doc_id FROM documents)) AS known, count(*) FILTER (d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL) AS matched, count(*) FILTER (l.doc_id IS NULL) AS missing, count(*) FILTER (d.doc_id IS NULL) AS unknown, count(*) FILTER (d.doc_id IS NULL OR l.doc_id IS NULL) = 0 AS equal FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)")
def key_set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether documents and labels have the same ids, and how many either lacks."""
    return joins.key_sets(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 4 = 0 THEN 'new ' || o_orderstatus END, o_orderstatus) AS status, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END IS NULL AS overlaid FROM orders")
def enrichment_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of an enrichment laid over the base rows: all base rows stay, and a missing value doesn't replace one."""
    base = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    extra = base.where("o_orderkey % 2 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("new "), "o_orderstatus")).alias("value"))
    return joins.overlaid(base.withColumnRenamed("o_orderstatus", "status"), extra, "o_orderkey", "status")


@query(f"WITH {sql.records('suppliers', 'customers')}, k AS (SELECT 'suppliers:' || s_suppkey AS key, s_name AS entry FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'by own id ' || c_custkey FROM customer WHERE c_custkey % 3 = 0) SELECT r.id, coalesce(a.entry, b.entry) AS entry FROM r LEFT JOIN k a ON a.key = r.id LEFT JOIN k b ON b.key = r.native_id")
def entry_by_either_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries found by a record's id or else by its own source's id: two equi-joins, no condition with OR."""
    own = records(spark, sf_dir, "suppliers", "customers").select("id", "native_id")
    first = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.concat(F.lit("suppliers:"), F.col("s_suppkey").cast("string")).alias("key"), F.col("s_name").alias("entry"))
    second = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").cast("string").alias("key"), F.concat(F.lit("by own id "), F.col("c_custkey").cast("string")).alias("entry"))
    return joins.by_either_key(own, first.unionAll(second), "id", "native_id").select("id", "entry")


ALLOWED = [("click", "live"), ("view", "live"), ("view", "cached"), ("signup", "live"), ("purchase", "cached"), ("error", "none")]
TRANSPORT = "CASE event_id % 3 WHEN 0 THEN 'live' WHEN 1 THEN 'cached' ELSE 'none' END"


@query(f"SELECT event_id, event_type AS state, {TRANSPORT} AS transport FROM events WHERE (event_type, {TRANSPORT}) NOT IN ({', '.join(map(str, ALLOWED))})")
def forbidden_transports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose state doesn't allow their transport."""
    own = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("state"), F.expr(TRANSPORT).alias("transport"))
    return joins.not_allowed(own, spark.createDataFrame(ALLOWED, "state string, transport string"), "state", "transport").select("event_id", "state", "transport")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '1%' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber > 1)")
def critical_without_remedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Critical issues without a remediation of the first priority: urgent orders with no second line."""
    critical = table(spark, sf_dir, "orders").where("o_orderpriority LIKE '1%'").select("o_orderkey")
    remedies = table(spark, sf_dir, "lineitem").where("l_linenumber > 1").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.without_counterpart(critical, remedies, "o_orderkey")


@query("SELECT query_id, rule FROM (SELECT c.conv_id AS query_id, 'duplicate id' AS rule FROM conversations c GROUP BY c.conv_id, lower(role) HAVING count(*) > 1 UNION SELECT conv_id, 'status' FROM conversations WHERE turn % 4 = 3 UNION SELECT conv_id, 'evidence' FROM conversations WHERE turn % 2 = 0 AND conv_id % 3 = 0)")
def ranking_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on submitted rankings: results once each, statuses known, evidence for each claim. Conversations stand for rankings, roles for results."""
    own = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("query_id"), F.lower("role").alias("result"), F.when(F.col("turn") % 4 == 3, "certified").otherwise("aligned").alias("status"), F.when(~((F.col("turn") % 2 == 0) & (F.col("conv_id") % 3 == 0)), "there").alias("evidence"))
    twice = joins.repeated(own, "query_id", "result").select("query_id", F.lit("duplicate id").alias("rule"))
    rules = {"status": F.col("status").isin(*s.STATUSES), "evidence": F.col("evidence").isNotNull()}
    return twice.unionAll(validate.violations(own, "query_id", rules)).distinct()
