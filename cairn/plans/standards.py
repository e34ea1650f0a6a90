"""Queries over standards of records, facets of records that have all columns, and all measures of a suite of queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import index, relate, standards
from cairn.operators.gaps import evidence_score
from cairn.plans import sql
from cairn.plans.registry import query
from cairn.plans.relate import MORE, MORE_SQL, PAIRS_SQL
from cairn.plans.search import FIELDS_SQL
from cairn.sources.records import records, table

#: What records of the lanes lack, as expressions of Spark and of SQL alike.
OWN = {
    "provenance": "url", "dimension_count": "CASE WHEN record_type = 'Part' THEN length(title) % 3 END", "quality_evidence": "CASE WHEN length(title) % 2 = 0 THEN 'scored' END", "modified": "CASE WHEN record_type = 'Page' THEN '2026-01-01' END",
    "retrieved_at": "CASE WHEN record_type = 'Supplier' THEN '2025-01-01' END", "table_codes": "declared_code", "method_count": "length(title) % 2", "documentation_count": "length(title) % 3",
}
OWN_SQL = "o AS (SELECT *, " + ", ".join(f"{v} AS {k}" for k, v in OWN.items()) + " FROM r)"


def described(rows: DataFrame) -> DataFrame:
    """Records with provenance, dimensions, dates and links."""
    own = rows.select("*", *(F.expr(v).alias(k) for k, v in OWN.items()))
    link = lambda n: F.when(F.col(n) > 0, F.array(F.lit("https://m.example/"))).otherwise(F.array().cast("array<string>"))
    return own.withColumns({"metadata_modified": F.col("modified"), "methodology_links": link("method_count"), "quality_links": link("documentation_count"), "declared_table_codes": F.col("table_codes"), "geography": F.col("area_served")})


FLAGS_SQL = """f AS (SELECT *, coalesce(provenance <> '', false) AS prov, coalesce(dimension_count > 0, false) AS dims, source_surface = 'parts' AS own FROM o)"""


@query(
    f"""WITH {sql.records()}, {OWN_SQL}, {FLAGS_SQL}, s AS (SELECT source_surface, unnest([
      {{'s': 'code-of-practice-3.0', 't': 'partial', 'e': (modified IS NOT NULL AND prov) OR method_count > 0 OR documentation_count > 0 OR len(quality_notes) > 0 OR (coalesce(trim(notes), '') <> '' AND len(topics) > 0)}}, {{'s': 'dcat-3', 't': 'aligned', 'e': coalesce(trim(title), '') <> '' AND coalesce(trim(url), '') <> ''}},
      {{'s': 'dqv', 't': 'partial', 'e': quality_evidence IS NOT NULL}}, {{'s': 'prov-o', 't': CASE WHEN prov THEN 'aligned' ELSE 'partial' END, 'e': prov}}, {{'s': 'sdmx', 't': CASE WHEN own THEN 'aligned' ELSE 'not-applicable' END, 'e': dims}},
      {{'s': 'data-cube', 't': CASE WHEN dims THEN 'partial' ELSE 'not-evaluated' END, 'e': dims}}]) AS x FROM f)
    SELECT source_surface, x.s AS standard, x.t AS status, count(*) AS n, count(*) FILTER (coalesce(x.e, false)) AS evidenced FROM s GROUP BY ALL"""
)
def standard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by source, standard and status, and how many of them evidence it."""
    own = standards.with_standards(described(records(spark, sf_dir)), "parts").select("source_surface", F.explode("standards").alias("s"))
    return own.groupBy("source_surface", "s.standard", "s.status").agg(F.count(F.lit(1)).alias("n"), F.count_if("s.evidence").alias("evidenced"))


@query(
    f"""WITH {sql.records()}, {OWN_SQL}, {FLAGS_SQL}, c AS (SELECT id, unnest([{{'s': 'DCAT-AP', 't': 'partial', 'e': concat_ws(' ', id, title, url)}}, {{'s': 'SDMX', 't': CASE WHEN own THEN 'aligned' WHEN dims THEN 'partial' ELSE 'not-applicable' END, 'e': CASE WHEN own OR dims THEN source_surface END}},
      {{'s': 'ISO 8601', 't': CASE WHEN coalesce(modified, retrieved_at) IS NULL THEN 'not-evaluated' ELSE 'partial' END, 'e': coalesce(modified, retrieved_at)}}, {{'s': 'PROV-O', 't': CASE WHEN prov THEN 'aligned' ELSE 'not-evaluated' END, 'e': nullif(provenance, '')}},
      {{'s': 'GSS geography codes', 't': CASE WHEN len(area_served) > 0 OR table_codes IS NOT NULL THEN 'partial' ELSE 'not-evaluated' END, 'e': coalesce(nullif(array_to_string(area_served, ','), ''), table_codes)}}]) AS x FROM f)
    SELECT id, x.s AS standard, x.t AS status, x.e AS evidence FROM c"""
)
def standard_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = standards.with_claims(described(records(spark, sf_dir)), "parts").select("id", F.explode("claims").alias("c"))
    return own.select("id", "c.standard", "c.status", "c.evidence")


@query(f"WITH {sql.records()}, {OWN_SQL} SELECT count(*) AS denominator, count(*) FILTER (method_count > 0) AS methodology_links, count(*) FILTER (documentation_count > 0) AS quality_links, count(*) FILTER (provenance <> '') AS provenance, count(*) FILTER (dimension_count > 0) AS dimensions FROM o")
def evidence_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standards.availability(described(records(spark, sf_dir)))


@query("SELECT count(*) AS standards, CAST(sum(n) AS BIGINT) AS requirements, max(day) AS current_as_of FROM (SELECT r_regionkey, count(n_nationkey) AS n, '2026-0' || (any_value(r_regionkey) + 1) AS day FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey)")
def standards_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as a register of standards, their nations as requirements."""
    nations = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.collect_list("n_name").alias("requirements"))
    own = table(spark, sf_dir, "region").join(nations, "r_regionkey", "left")
    return standards.register_summary(own.select(F.col("r_name").alias("id"), F.format_string("2026-0%d", (F.col("r_regionkey") + 1).cast("int")).alias("current_as_of"), "requirements"))


WORDS = ("aligned", "sdmx", "cube", "almond")


@query(
    f"WITH {sql.records()}, {OWN_SQL}, {FLAGS_SQL}, n AS (SELECT *, concat('code-of-practice-3.0 partial dcat-3 aligned dqv partial prov-o ', CASE WHEN prov THEN 'aligned' ELSE 'partial' END, ' sdmx ', CASE WHEN own THEN 'aligned' ELSE 'not-applicable' END, ' data-cube ', CASE WHEN dims THEN 'partial' ELSE 'not-evaluated' END) AS standards FROM f), t AS ("
    + " UNION ALL ".join(f"SELECT id, {index.WEIGHTS[f]} AS w, unnest({sql.tokens(f'coalesce({x}, {chr(39) * 2})')}) AS token FROM n" for f, x in (FIELDS_SQL | {"standards": "standards"}).items())
    + f"), s AS (SELECT id, count(DISTINCT token) AS matched, sum(w) AS score FROM t WHERE list_contains({sql.quoted(WORDS)}, token) GROUP BY id) SELECT id, CAST(matched AS INTEGER) AS matched, CAST(score AS INTEGER) AS score FROM s JOIN r USING (id) ORDER BY matched DESC, score DESC, lower(title), id LIMIT 10"
)
def search_with_standards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best records for a query some of whose words only standards have."""
    own = standards.with_standards(described(records(spark, sf_dir)), "parts")
    return index.ranked(own, " ".join(WORDS)).select("id", "matched", "score")


MODES = "CASE WHEN record_type = 'Part' THEN 'declared' WHEN url IS NOT NULL THEN 'extracted' END"
FIVE_SQL = {
    "subtopic": "subtopic", "geography_vintage": "geography_vintage::VARCHAR", "derivation_mode": MODES, "binding_status": "CASE WHEN record_type IN ('Document', 'Page') THEN 'available' ELSE 'planned' END", "has_alternatives": "CASE WHEN h.id IS NULL THEN 'no' ELSE 'yes' END",
}


@query(
    PAIRS_SQL + f", {MORE_SQL}, h AS (SELECT DISTINCT id FROM q WHERE rank <= 4), v AS (" + " UNION ALL ".join(f"SELECT '{k}' AS facet, coalesce(nullif({v}, ''), '__missing__') AS value FROM m LEFT JOIN h USING (id)" for k, v in FIVE_SQL.items())
    + ") SELECT facet, value, count(*) AS n FROM v GROUP BY ALL"
)
def further_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subtopic, vintage of the geography, modes of derivation, binding and alternatives: facets of records that have them."""
    own = records(spark, sf_dir)
    near = relate.alternatives(own.select("id", "source_surface", "title", "topics", "tags")).groupBy("id").agg(F.count(F.lit(1)).alias("alternative_count"))
    more = own.select("*", *(F.expr(v).alias(k) for k, v in MORE.items())).withColumns({
        "derivation_modes": F.array(F.expr(MODES)), "binding_status": F.when(F.col("record_type").isin("Document", "Page"), "available").otherwise("planned"), "ordinal": F.lit(0)})
    values = index.facet_values(more.join(near, "id", "left"), evidence_score())
    return values.where(F.col("facet").isin(*FIVE_SQL)).groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


S = "s_suppkey"
#: Places of the target, a companion and an alternative in a supplier's ranking of twelve; by the last the alternative must appear.
TARGET, COMPANION, ALTERNATIVE, BY = f"CASE WHEN {S} % 7 = 6 THEN 12 ELSE {S} % 4 + 1 END", f"{S} % 3 + 5", f"CASE WHEN {S} % 5 = 4 THEN 40 ELSE {S} % 3 + 8 END", f"{S} % 4 + 8"


def rankings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A query for each supplier, and its ranking: evidence, contrasts and claims of the target by the supplier's number. Every 19th query has no results."""
    at = {n: F.expr(v).cast("int") for n, v in (("t", TARGET), ("c", COMPANION), ("a", ALTERNATIVE), ("by", BY))}
    own = table(spark, sf_dir, "supplier").select(S, F.concat(F.lit("q"), F.col(S).cast("string")).alias("query_id"), *(v.alias(k) for k, v in at.items()))
    name = lambda x: F.concat(F.lit("r"), F.col(x).cast("string"))
    texts = lambda *x: F.array(*map(F.lit, x))
    suite = own.select(
        "query_id", name("t").alias("target"), F.create_map(name("t"), F.lit(3), name("c"), F.lit(1)).alias("relevance"), F.array(F.struct(name("a").alias("id"), F.col("by").alias("must_expose_by"), texts("measure", "unit").alias("contrast"))).alias("alternatives"),
        texts("title", "statistical.measure").alias("evidence"), F.when(F.col(S) % 8 == 7, texts()).otherwise(texts("DCAT-AP", "SDMX")).cast("array<string>").alias("standards"),
    )
    each = own.where(f"{S} % 19 <> 5").withColumn("rank", F.explode(F.sequence(F.lit(1), F.lit(12))))
    claim = lambda n, st, e: F.struct(F.lit(n).alias("standard"), F.lit(st).alias("status"), e.alias("evidence"))
    results = each.select(
        "query_id", name("rank").alias("id"), "rank", F.create_map(F.lit("title"), F.lit("x"), F.lit("statistical.measure"), F.when(F.col(S) % 2 == 0, "m").otherwise(" ")).alias("metadata"),
        F.create_map(F.lit("measure"), F.lit("rate"), F.lit("unit"), F.when(F.col(S) % 3 == 0, "%")).alias("contrast"),
        F.array(claim("dcat_ap", "partial", F.when(F.col(S) % 3 != 1, "mapping")), claim("sdmx", "not-evaluated", F.lit("x"))).alias("claims"),
    )
    return suite, results


GAIN = lambda k: f"((tr <= {k})::INT * 7 / log2(tr + 1) + (cr <= {k})::INT / log2(cr + 1)) / (7 / log2(2){' + 1 / log2(3)' if k > 1 else ''})"


@query(
    f"""WITH q AS (SELECT {S} AS s, {TARGET} AS t, {COMPANION} AS c, {ALTERNATIVE} AS a, {BY} AS must, {S} % 19 = 5 AS none FROM supplier), r AS (SELECT *, CASE WHEN none THEN 99 ELSE t END AS tr, CASE WHEN none THEN 99 ELSE c END AS cr, CASE WHEN none OR a > 12 THEN 99 ELSE a END AS ar, greatest(10, must) AS depth FROM q)
    SELECT 'q' || s AS query_id, depth::INTEGER AS depth, CASE WHEN NOT none THEN t END::INTEGER AS target_rank, """
    + ", ".join(f"((tr <= {k})::INT + (cr <= {k})::INT) / 2 AS recall_{k}, round({GAIN(k)}, 6) AS ndcg_{k}" for k in (1, 3, 5, 10))
    + """, CASE WHEN none THEN 0 ELSE round(1 / least(tr, cr), 6) END AS mrr, CASE WHEN tr <= depth THEN round(1 / tr, 6) ELSE 0 END AS primary_mrr, (ar <= must)::INT::DOUBLE AS exposure, CASE WHEN ar <= must THEN CASE WHEN s % 3 = 0 THEN 1 ELSE 0.5 END ELSE 0 END::DOUBLE AS contrast,
    CASE WHEN tr <= depth THEN CASE WHEN s % 2 = 0 THEN 1 ELSE 0.5 END ELSE 0 END::DOUBLE AS evidence, CASE WHEN s % 8 = 7 THEN 1 WHEN tr <= depth AND s % 3 <> 1 THEN 0.5 ELSE 0 END::DOUBLE AS standards_coverage,
    CASE WHEN tr <= depth THEN CASE WHEN s % 2 = 0 THEN '' ELSE 'statistical.measure' END ELSE 'title,statistical.measure' END AS missing_evidence, CASE WHEN s % 8 = 7 THEN '' WHEN tr <= depth AND s % 3 <> 1 THEN 'SDMX' ELSE 'DCAT-AP,SDMX' END AS missing_standards FROM r"""
)
def query_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every measure of every query of a suite, with what its target lacks."""
    got = standards.evaluate(*rankings(spark, sf_dir), (1, 3, 5, 10))
    return got.withColumns({c: F.array_join(c, ",") for c in ("missing_evidence", "missing_standards")})
