"""Indicators: documents of a register as records, with their producers, geography, dimensions and how each field came about.

``projected`` takes documents that the register includes (``cubes``) and keeps what may be published; ``indicator_records`` maps those to records. Producers are the parties that a figure comes from:
a record is published by its only one, by none, or by several under a common name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.text import plain_text, public_host
from cairn.functions.values import text_list
from cairn.operators import derivations
from cairn.operators.validate import violations
from cairn.sources.cubes import SLUG

LANE = "local-statistics"
ROOT = "https://statistics.example/indicators"
#: Countries by code, and what stands where no producer, or more than one, is evidenced.
COUNTRIES = {"E": "England", "N": "Northern Ireland", "S": "Scotland", "W": "Wales"}
NO_PRODUCER, SEVERAL = ("source-producer-not-evidenced", "Source producer not evidenced"), "multiple-source-producers"
EXTENSION = (
    "struct<slug: string, topic: string, subTopic: string, dataset: string, code: string, description: string, subtitle: string, measure: string, unit: string, frequency: string, periodDomain: array<string>, decimalPlaces: int, "
    "experimentalStatistic: boolean, dataModified: string, metadataModified: string, geography: struct<countries: array<string>, levels: array<string>, types: array<string>, year: int, initialLevel: string>, source: array<struct<name: string, href: string, date: string>>>"
)
#: What is derived for a field: its mode, where it comes from and by what.
DERIVED = {
    "type": {"mode": "source-declared", "sourceField": "recordKind"}, "quality_notes": {"mode": "source-declared", "sourceField": "caveats"}, "area_served": {"mode": "controlled-vocabulary-crosswalk", "sourceField": "geography.countries", "crosswalk": "country-code-v1"},
    "endpoint_host": {"mode": "deterministic-extraction", "sourceField": "links.metadata"}, "documentation_host": {"mode": "deterministic-extraction", "sourceField": "links.self"},
}
GIVEN_MODES = ("application-curated-extract", "inferred-from-observation-structure-without-publishing-observations", "inferred-from-area-code-coverage")


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def indicator_faults(items: DataFrame, key: str) -> DataFrame:
    """(key, rule) for documents (key, title, caveats, extension) that can't be projected."""
    e = F.col("extension")
    g, texts = e["geography"], ("slug", "topic", "subTopic", "dataset", "code", "description", "subtitle", "measure", "unit", "frequency", "dataModified", "metadataModified")
    matches = lambda c, pattern: F.forall(g[c], lambda x: F.coalesce(x.rlike(pattern), F.lit(False))) & (F.size(F.array_distinct(g[c])) == F.size(g[c]))
    rules = {"title": ~blank(F.col("title")), "slug": F.coalesce(e["slug"].rlike(SLUG), F.lit(False)), **{f"required {c}": ~blank(e[c]) for c in texts if c != "slug"}}
    rules |= {
        "period": (F.size(e["periodDomain"]) == 2) & F.forall(e["periodDomain"], lambda x: ~blank(x)), "caveats": F.col("caveats").isNotNull() & F.forall("caveats", lambda x: x.isNotNull()), "decimal places": e["decimalPlaces"].between(0, 12),
        "countries": matches("countries", "^[ENSW]$"), "levels": matches("levels", SLUG), "area codes": matches("types", r"^[EKNSW]\d{2}$"), "vintage": g["year"].between(1900, 2200), "initial level": F.array_contains(g["levels"], g["initialLevel"]),
        "no source": F.size(e["source"]) > 0, "source": F.forall(e["source"], lambda s: ~blank(s["name"]) & ~blank(s["date"]) & F.coalesce(s["href"].rlike(r"^https://[^\s@]+$"), F.lit(False))), "flags": e["experimentalStatistic"].isNotNull(),
    }
    return violations(items, key, rules)


def indicator_records(items: DataFrame, aliases: DataFrame) -> DataFrame:
    """Records of documents (title, caveats, dimensions, extension) without faults; ``aliases`` (alias, target) are names that they had."""
    e = F.col("extension")
    slug, g = e["slug"], e["geography"]
    producers = F.filter(F.transform(e["source"], lambda s: F.struct(plain_text(s["name"], 500).alias("name"), s["href"].alias("url"))), lambda p: p["name"] != "")
    only, several = F.get(producers, F.lit(0)), F.size(producers) > 1
    names = F.transform(g["countries"], lambda c: F.coalesce(*(F.when(c == k, F.lit(v)) for k, v in COUNTRIES.items())))
    self_url, metadata_url = F.concat(F.lit(f"{ROOT}/"), slug), F.concat(F.lit(f"{ROOT}/metadata/"), slug)
    caveats = F.filter(F.transform("caveats", lambda c: plain_text(c)), lambda c: c != "")
    own = items.select(
        F.concat(F.lit(f"{LANE}:indicator:"), slug).alias("id"), slug.alias("native_id"), F.lit(LANE).alias("source_surface"), F.lit("Local Statistics Indicator").alias("record_type"), F.lit("curated-local-indicator").alias("type"),
        F.coalesce(F.nullif(plain_text(F.col("title"), 1000), F.lit("")), slug).alias("title"), plain_text(e["description"]).alias("notes"), self_url.alias("url"), text_list(F.array(e["topic"], e["subTopic"])).alias("topics"), e["subTopic"].alias("subtopic"),
        F.when(several, SEVERAL).otherwise(F.coalesce(F.lower(F.regexp_replace(only["name"], "[^A-Za-z0-9]+", "-")), F.lit(NO_PRODUCER[0]))).alias("publisher"),
        F.when(several, F.concat(F.size(producers).cast("string"), F.lit(" attributed source producers"))).otherwise(F.coalesce(only["name"], F.lit(NO_PRODUCER[1]))).alias("publisher_title"),
        F.when(~several, only["url"]).alias("publisher_uri"), F.transform(producers, lambda p: p["name"]).alias("source_publishers"), F.lit("published").alias("state"), e["metadataModified"].alias("metadata_modified"), e["dataModified"].alias("data_modified"),
        e["frequency"].alias("frequency"), e["measure"].alias("measure"), e["unit"].alias("unit_of_measure"), e["dataset"].alias("dataset_family"), e["code"].alias("indicator_code"), g["levels"].alias("geography"), g["year"].alias("geography_vintage"), F.array_compact(names).alias("area_served"),
        F.get(e["periodDomain"], F.lit(0)).alias("time_start"), F.get(e["periodDomain"], F.lit(1)).alias("time_end"), F.size("dimensions").alias("dimension_count"), caveats.alias("quality_notes"), public_host(metadata_url).alias("endpoint_host"), public_host(self_url).alias("documentation_host"),
        F.lit("not-evaluated").alias("license_id"), F.lit("planned").alias("binding_status"), e["experimentalStatistic"].alias("experimental"),
    )
    had = {"type": F.lit(True), "quality_notes": F.size("quality_notes") > 0, "area_served": F.size("area_served") > 0, "endpoint_host": F.col("endpoint_host").isNotNull(), "documentation_host": F.col("documentation_host").isNotNull()}
    details = {f: F.create_map(*(F.lit(x) for pair in d.items() for x in pair)) for f, d in DERIVED.items()}
    fields = F.map_from_entries(F.filter(F.array(*(F.when(had[f], F.struct(F.lit(f).alias("key"), details[f].alias("value"))) for f in DERIVED)), F.isnotnull))
    own = own.withColumn("derivation", fields).withColumn("derivation_modes", derivations.modes_of(F.array(*map(F.lit, GIVEN_MODES)), F.col("derivation")))
    former = aliases.groupBy(F.col("target").alias("native_id")).agg(F.array_sort(F.collect_list("alias")).alias("native_aliases"))
    return own.join(former, "native_id", "left").withColumn("native_aliases", F.coalesce("native_aliases", F.array().cast("array<string>")))
