"""Queries over the lane mappers: raw items are made of table rows, wrapped in pages, mapped to records and finalised."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.evidence import AREAS
from cairn.plans.evidence import named_sql
from cairn.plans.registry import query
from cairn.plans.sources import made_pages
from cairn.sources import lanes, pages
from cairn.sources.records import table

K = "c_custkey"
LINK = f"CASE {K} % 4 WHEN 0 THEN concat('https://catalogue.example/v1/datasets/d', CAST({K} AS STRING), '/editions/e', CAST({K} % 5 AS STRING), '/versions/', CAST({K} % 9 AS STRING)) WHEN 1 THEN concat('https://catalogue.example/v1/datasets/d', CAST({K} AS STRING), '/editions/e', CAST({K} % 5 AS STRING)) WHEN 2 THEN 'https://other.example/x' END"
SELF = f"CASE WHEN {K} % 3 = 0 THEN concat('https://own.example/', CAST({K} AS STRING)) END"
SEEN, MADE = f"CASE WHEN {K} % 3 = 0 THEN '2026-01-01' ELSE '' END", f"CASE WHEN {K} % 2 = 0 THEN '2025-05-05' END"


def catalogue_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    href = lambda x: F.struct(F.expr(x).alias("href"))
    item = F.struct(
        F.when(F.col(K) % 11 != 0, F.concat(F.lit("d"), F.col(K).cast("string"))).alias("id"), F.when(F.col(K) % 7 != 0, F.concat(F.lit("<b>"), "c_name", F.lit("</b>"))).alias("title"), F.concat(F.lit("About &amp; "), "c_mktsegment").alias("description"),
        F.struct(href(SELF).alias("self"), href(LINK).alias("latest_version")).alias("links"), F.array(F.col("c_mktsegment"), F.lit("b"), F.lit("b")).alias("keywords"), F.when(F.col(K) % 5 == 0, "retired").alias("state"),
        F.struct(F.when(F.col(K) % 2 == 0, "people").alias("id")).alias("is_based_on"), F.lit("2024").alias("last_updated"), F.when(F.col(K) % 6 == 0, F.array(F.lit("note"))).alias("quality_notes"),
        F.array(F.lit("https://m.example/")).alias("methodology_links"), F.array(F.lit("https://a.example/q")).alias("quality_links"),
    )
    return pages.items(made_pages(table(spark, sf_dir, "customer"), K, item, '{"items":[@]}'), "$.items", "$.results")


EDITION_SQL, VERSION_SQL = f"CASE WHEN {K} % 4 = 0 THEN 'e' || {K} % 5 END", f"CASE WHEN {K} % 4 = 0 THEN CAST({K} % 9 AS VARCHAR) END"


@query(
    f"""SELECT 'catalogue:dataset:d' || {K} AS id, CASE WHEN {K} % 7 <> 0 THEN c_name ELSE 'd' || {K} END AS title, 'About & ' || c_mktsegment AS notes, CASE WHEN {K} % 3 = 0 THEN 'https://own.example/' || {K} ELSE 'https://catalogue.example/v1/datasets/d' || {K} END AS url,
    array_to_string(list_sort([c_mktsegment, 'b']), ',') AS topics, CASE WHEN {K} % 5 = 0 THEN 'retired' ELSE 'published' END AS state, CASE WHEN {K} % 2 = 0 THEN 'people' END AS population_type, {EDITION_SQL} AS latest_edition, {VERSION_SQL} AS latest_version,
    CASE {K} % 4 WHEN 0 THEN 'ons_data.dimensions' ELSE 'ons_data.editions' END AS selection_tool, 'dataset=d' || {K} || CASE WHEN {K} % 4 = 0 THEN ',edition=e' || {K} % 5 ELSE '' END || CASE WHEN {K} % 4 = 0 THEN ',version=' || {K} % 9 ELSE '' END AS arguments FROM customer WHERE {K} % 11 <> 0"""
)
def catalogue_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue items as records, with the tool by which their selection goes on."""
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("selection_arguments")), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ",")
    got = lanes.catalogue_records(catalogue_items(spark, sf_dir))
    return got.select("id", "title", "notes", "url", F.array_join("topics", ",").alias("topics"), "state", "population_type", "latest_edition", "latest_version", "selection_tool", shown.alias("arguments"))


@query(
    f"""SELECT 'catalogue:dataset:d' || {K} AS id, CASE WHEN {K} % 3 = 0 THEN '2026-01-01' WHEN {K} % 2 = 0 THEN '2025-05-05' ELSE '' END AS source_as_of, CASE WHEN {K} % 3 = 0 THEN 'provenance.retrieved_at' WHEN {K} % 2 = 0 THEN 'provenance.source_commit_as_of' ELSE 'not-evidenced' END AS basis,
    'd' || {K} || '/' || coalesce({EDITION_SQL}, '') || '/' || coalesce({VERSION_SQL}, '') AS identity, CASE WHEN {K} % 6 = 0 THEN 'note' ELSE 'https://a.example/q,https://m.example/' END AS quality_notes FROM customer WHERE {K} % 11 <> 0"""
)
def finalised_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provenance, identity and statistical description of catalogue records, of which some were retrieved at a known time and some come from a dated commit."""
    number = F.substring("native_id", 2, 20).cast("long").alias(K)
    own = lanes.catalogue_records(catalogue_items(spark, sf_dir)).withColumn(K, number)
    got = lanes.finalised(own.withColumns({"retrieved_at": F.expr(SEEN), "commit_as_of": F.expr(MADE)}), "snapshot-1")
    return got.select(
        "id", F.col("provenance.source_as_of").alias("source_as_of"), F.col("provenance.source_as_of_basis").alias("basis"),
        F.concat_ws("/", "identity.dataset_id", "identity.latest_edition", "identity.latest_version").alias("identity"), F.array_join("statistical.quality_notes", ",").alias("quality_notes"),
    )


@query(
    """SELECT 'structures:dataset:' || CASE WHEN p_partkey % 5 = 0 THEN 'agency' || p_partkey ELSE 'NM_' || p_partkey END AS id, CASE WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 5 = 0 THEN 'agency' || p_partkey ELSE 'NM_' || p_partkey END AS title,
    CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE 'first ' || p_brand || CASE WHEN p_partkey % 4 = 1 THEN ' second' ELSE '' END END AS notes, 'https://structures.example/api/dataset/' || CASE WHEN p_partkey % 5 = 0 THEN 'agency' || p_partkey ELSE 'NM_' || p_partkey END || '.overview.json' AS url,
    'nomis,sdmx' AS tags, 'nomis_query' AS query_tool FROM part"""
)
def structure_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key families as records: ids of agencies, names in objects, descriptions in one or several annotations."""
    k = F.col("p_partkey")
    note = lambda c: F.struct(F.struct(c.alias("text")).alias("annotationtext"))
    first, second = note(F.concat(F.lit("first "), "p_brand")), note(F.lit("second"))
    notes = F.when(k % 4 == 1, F.to_json(F.array(first, second))).otherwise(F.to_json(first))
    item = F.struct(
        F.when(k % 5 != 0, F.concat(F.lit("NM_"), k.cast("string"))).alias("id"), F.concat(F.lit("agency"), k.cast("string")).alias("agencyid"), F.struct(F.when(k % 3 == 0, F.col("p_name")).alias("value")).alias("name"),
        F.when(k % 2 == 0, F.col("p_type")).alias("description"), F.struct(F.parse_json(notes).alias("annotation")).alias("annotations"),
    )
    own = pages.items(made_pages(table(spark, sf_dir, "part"), "p_partkey", item, '{"structure":{"keyfamilies":{"keyfamily":[@]}}}'), "$.structure.keyfamilies.keyfamily")
    return lanes.structure_records(own).select("id", "title", "notes", "url", F.array_join("tags", ",").alias("tags"), "query_tool")


G = "s_suppkey"
YEAR_SQL = f"CASE WHEN {G} % 2 = 0 THEN 2000 + {G} % 25 END"


@query(
    f"""SELECT 'geography:dataset:g' || {G} AS id, CASE WHEN {G} % 2 = 0 THEN 'Wards ' || (2000 + {G} % 25) ELSE s_name END AS title, CASE WHEN {G} % 3 = 0 THEN 'Updated quarterly.' ELSE 'A snippet.' END AS notes, CASE WHEN {G} % 3 = 0 THEN 'quarterly' END AS frequency,
    CASE {G} % 4 WHEN 0 THEN 'https://u.example/' || {G} WHEN 1 THEN 'https://l.example/' || {G} ELSE 'https://geography.example/datasets/g' || {G} END AS url, CAST({YEAR_SQL} AS INTEGER) AS vintage, CASE WHEN {G} % 5 = 0 THEN 'Geography' ELSE 'UK,wards' END AS topics,
    CASE WHEN {G} % 5 = 0 THEN '' ELSE {named_sql("'uk'", AREAS)} END AS areas, CASE WHEN {G} % 3 = 1 THEN CAST({G} % 10 AS DOUBLE) END AS west, CASE WHEN {G} % 7 = 0 THEN 'public' END AS access_model, CASE WHEN {G} % 2 = 0 THEN 'm1' ELSE 'm2' END AS modified FROM supplier"""
)
def geography_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features as records: properties under several names, extents of too few numbers, years in titles."""
    k = F.col(G)
    text: Column = k.cast("string")
    box = F.when(k % 3 == 1, F.array((k % 10).cast("double"), F.lit(50.0), F.lit(20.0), F.lit(55.0), F.lit(9.0))).otherwise(F.array(F.lit(1.0)))
    properties = F.struct(
        F.when(k % 2 == 0, F.concat(F.lit("Wards "), (k % 25 + 2000).cast("string"))).alias("title"), F.col("s_name").alias("name"), F.when(k % 3 == 0, "Updated quarterly.").alias("description"), F.lit("A snippet.").alias("snippet"),
        F.when(k % 4 == 0, F.concat(F.lit("https://u.example/"), text)).alias("url"), F.when(k % 4 < 2, F.concat(F.lit("https://l.example/"), text)).alias("landing_page"),
        F.when(k % 5 != 0, F.array(F.lit("wards"), F.lit("UK"))).alias("tags"), F.when(k % 7 == 0, "Public").otherwise("private").alias("access"), F.when(k % 2 == 0, "m1").alias("modified"), F.lit("m2").alias("updated"),
    )
    item = F.struct(F.concat(F.lit("g"), text).alias("id"), box.alias("bbox"), properties.alias("properties"))
    own = pages.items(made_pages(table(spark, sf_dir, "supplier"), G, item, '{"features":[@]}'), "$.features")
    return lanes.geography_records(own).select(
        "id", "title", "notes", "frequency", "url", F.col("geography_vintage").alias("vintage"), F.array_join("topics", ",").alias("topics"), F.array_join("area_served", ",").alias("areas"), F.get("bbox", 0).alias("west"), "access_model", F.col("metadata_modified").alias("modified")
    )
