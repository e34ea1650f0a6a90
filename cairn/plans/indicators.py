"""Queries over indicators: one document for each part, with suppliers as producers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.plans.registry import query
from cairn.sources import indicators
from cairn.sources.records import table

K = "p_partkey"


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, title, caveats, dimensions, extension): none to two producers by the part's number, defects by others."""
    k = F.col(K)
    producer = lambda n: F.struct(F.concat(F.lit("Office <b>"), (k % 7 + n).cast("string"), F.lit("</b>")).alias("name"), F.when(k % 41 == 3, "http://p.example").otherwise(F.concat(F.lit("https://p.example/"), (k % 7 + n).cast("string"))).alias("href"), F.lit("2024").alias("date"))
    text = F.lit("text")
    extension = F.struct(
        F.when(k % 43 == 4, "Part 1").otherwise(F.concat(F.lit("part-"), k.cast("string"))).alias("slug"), F.col("p_type").alias("topic"), F.when(k % 47 == 5, " ").otherwise(F.col("p_brand")).alias("subTopic"), F.lit("parts").alias("dataset"), k.cast("string").alias("code"),
        text.alias("description"), text.alias("subtitle"), text.alias("measure"), text.alias("unit"), F.lit("Annual").alias("frequency"), F.when(k % 53 == 6, F.array(F.lit("2001"))).otherwise(F.array(F.lit("2001"), (F.lit(2002) + k % 9).cast("string"))).alias("periodDomain"),
        F.when(k % 59 == 7, 13).otherwise(2).alias("decimalPlaces"), F.when(k % 61 != 8, k % 2 == 0).alias("experimentalStatistic"), F.lit("2024-01-01").alias("dataModified"), F.lit("2024-02-02").alias("metadataModified"),
        F.struct(
            F.when(k % 67 == 9, F.array(F.lit("E"), F.lit("E"))).when(k % 2 == 0, F.array(F.lit("E"), F.lit("W"))).otherwise(F.array().cast("array<string>")).alias("countries"), F.array(F.lit("ltla"), F.lit("region")).alias("levels"), F.array(F.lit("E06")).alias("types"),
            F.when(k % 71 == 10, 1800).otherwise(2023).alias("year"), F.when(k % 73 == 11, "ward").otherwise("ltla").alias("initialLevel"),
        ).alias("geography"),
        F.when(k % 3 == 0, F.array(producer(0))).when(k % 3 == 1, F.array(producer(0), producer(1))).otherwise(F.array(F.struct(F.lit("<i></i>").alias("name"), F.lit("https://p.example/").alias("href"), F.lit("2024").alias("date")))).alias("source"),
    )
    caveats = F.when(k % 4 == 0, F.array(F.lit("Mind &amp; see"), F.lit(" "))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "part").select(K, F.col("p_name").alias("title"), caveats.alias("caveats"), F.array_repeat(F.lit("d"), (k % 4).cast("int")).alias("dimensions"), F.from_json(F.to_json(extension), indicators.EXTENSION).alias("extension"))


BROKEN_SQL = f"""list_filter([CASE WHEN {K} % 43 = 4 THEN 'slug' END, CASE WHEN {K} % 47 = 5 THEN 'required subTopic' END, CASE WHEN {K} % 53 = 6 THEN 'period' END, CASE WHEN {K} % 59 = 7 THEN 'decimal places' END, CASE WHEN {K} % 61 = 8 THEN 'flags' END, CASE WHEN {K} % 67 = 9 THEN 'countries' END,
 CASE WHEN {K} % 71 = 10 THEN 'vintage' END, CASE WHEN {K} % 73 = 11 THEN 'initial level' END, CASE WHEN {K} % 41 = 3 AND {K} % 3 <> 2 THEN 'source' END], lambda x: x IS NOT NULL)"""


@query(f"SELECT {K}, unnest({BROKEN_SQL}) AS rule FROM part")
def indicator_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.indicator_faults(items(spark, sf_dir), K)


@query(
    f"""WITH p AS (SELECT *, {K} % 3 AS n, 'Office ' || {K} % 7 AS one FROM part WHERE len({BROKEN_SQL}) = 0)
    SELECT 'local-statistics:indicator:part-' || {K} AS id, p_name AS title, CASE n WHEN 0 THEN 'office-' || {K} % 7 WHEN 1 THEN 'multiple-source-producers' ELSE 'source-producer-not-evidenced' END AS publisher,
    CASE n WHEN 0 THEN one WHEN 1 THEN '2 attributed source producers' ELSE 'Source producer not evidenced' END AS publisher_title, CASE WHEN n = 0 THEN 'https://p.example/' || {K} % 7 END AS publisher_uri, CASE n WHEN 0 THEN one WHEN 1 THEN one || ',Office ' || ({K} % 7 + 1) ELSE '' END AS producers,
    CASE WHEN {K} % 2 = 0 THEN 'England,Wales' ELSE '' END AS areas, CAST(2002 + {K} % 9 AS VARCHAR) AS time_end, CAST({K} % 4 AS INTEGER) AS dimension_count, CASE WHEN {K} % 4 = 0 THEN 'Mind & see' ELSE '' END AS notes,
    'application-curated-extract,' || CASE WHEN {K} % 2 = 0 THEN 'controlled-vocabulary-crosswalk,' ELSE '' END || 'deterministic-extraction,inferred-from-area-code-coverage,inferred-from-observation-structure-without-publishing-observations,source-declared' AS modes,
    (CASE WHEN {K} % 2 = 0 THEN 'area_served,' ELSE '' END) || 'documentation_host,endpoint_host,' || (CASE WHEN {K} % 4 = 0 THEN 'quality_notes,' ELSE '' END) || 'type' AS derived, CASE WHEN s_suppkey IS NOT NULL THEN 'old-' || s_suppkey ELSE '' END AS aliases
    FROM p LEFT JOIN supplier ON s_suppkey = {K}"""
)
def indicator_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without faults as records: their publisher, places, derivations and former names."""
    own = items(spark, sf_dir)
    good = own.join(indicators.indicator_faults(own, K).select(K).distinct(), K, "left_anti")
    aliases = table(spark, sf_dir, "supplier").select(F.concat(F.lit("old-"), F.col("s_suppkey").cast("string")).alias("alias"), F.concat(F.lit("part-"), F.col("s_suppkey").cast("string")).alias("target"))
    got = indicators.indicator_records(good, aliases)
    text = lambda c: F.array_join(c, ",")
    return got.select(
        "id", "title", "publisher", "publisher_title", "publisher_uri", text("source_publishers").alias("producers"), text("area_served").alias("areas"), "time_end", "dimension_count", text("quality_notes").alias("notes"), text("derivation_modes").alias("modes"),
        text(F.array_sort(F.map_keys("derivation"))).alias("derived"), text("native_aliases").alias("aliases"),
    )
