"""From items of raw pages to records of one schema: the catalogue, structure and geography lanes, and what all records get at the end.

Items come as variants, one a row (``pages.items``). Rows without an id are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.evidence import area_served, cadence, title_year
from cairn.functions.text import plain_text
from cairn.functions.values import text_list
from cairn.sources.pages import listed, text_at, texts, value_at

#: Roots of the sources' addresses.
CATALOGUE, STRUCTURES, GEOGRAPHY = "https://catalogue.example/v1", "https://structures.example/api", "https://geography.example"
#: Tools by which a selection is completed, and why it isn't complete.
DIMENSIONS, EDITIONS, QUERY, STRUCTURE_QUERY = "ons_data.dimensions", "ons_data.editions", "ons_data.query", "nomis_query"
COLUMNS = (
    "id", "native_id", "source_surface", "record_type", "title", "notes", "url", "topics", "tags", "state", "frequency", "population_type", "geography", "geography_vintage", "area_served", "bbox", "metadata_modified",
    "latest_edition", "latest_version", "access_model", "selection_tool", "selection_arguments", "query_tool", "binding_status", "methodology_links", "quality_links", "quality_notes",
)
LISTS = ("topics", "tags", "geography", "area_served", "methodology_links", "quality_links", "quality_notes")


def version_identity(link: Column) -> dict[str, Column]:
    """Dataset, edition and version that the path of a link names one after another; all null where it doesn't name the three."""
    part = lambda n: F.nullif(F.regexp_extract(link, "/datasets/([^/]+)/editions/([^/]+)/versions/([^/?#]+)", n), F.lit(""))
    return {"dataset": part(1), "edition": part(2), "version": part(3)}


def mapped(rows: DataFrame, lane: str, kind: str, **given: Column) -> DataFrame:
    empty = {c: F.array().cast("array<string>") if c in LISTS else F.lit(None).cast("string") for c in COLUMNS}
    empty |= {"bbox": F.lit(None).cast("array<double>"), "selection_arguments": F.create_map().cast("map<string,string>"), "geography_vintage": F.lit(None).cast("int")}
    given |= {"id": F.concat(F.lit(f"{lane}:dataset:"), given["native_id"]), "source_surface": F.lit(lane), "record_type": F.lit(kind)}
    return rows.select(*(given.get(c, empty[c]).alias(c) for c in COLUMNS)).where("native_id IS NOT NULL")


def catalogue_records(items: DataFrame) -> DataFrame:
    """Catalogue items. What a selection still needs follows from what its latest version's address names."""
    v = F.col("v")
    key, latest = text_at(v, "$.id"), text_at(v, "$.links.latest_version.href")
    known = version_identity(latest)
    exact = known["version"].isNotNull()
    arguments = F.map_filter(F.create_map(F.lit("dataset"), key, F.lit("edition"), known["edition"], F.lit("version"), known["version"]), lambda _, x: x.isNotNull())
    return mapped(
        items, "catalogue", "Catalogue Dataset", native_id=key, title=F.coalesce(F.nullif(plain_text(text_at(v, "$.title"), 1000), F.lit("")), key), notes=plain_text(text_at(v, "$.description")),
        url=F.coalesce(text_at(v, "$.links.self.href"), F.concat(F.lit(f"{CATALOGUE}/datasets/"), key)), topics=texts(v, "$.keywords"), tags=texts(v, "$.keywords"), state=F.coalesce(text_at(v, "$.state"), F.lit("published")),
        frequency=text_at(v, "$.release_frequency"), population_type=text_at(v, "$.is_based_on.id"), geography=texts(v, "$.geography"), metadata_modified=text_at(v, "$.last_updated"), latest_edition=known["edition"],
        latest_version=known["version"], selection_tool=F.when(exact, DIMENSIONS).otherwise(EDITIONS), selection_arguments=arguments, query_tool=F.lit(QUERY), binding_status=F.lit("available"),
        methodology_links=texts(v, "$.methodology_links"), quality_links=texts(v, "$.quality_links"), quality_notes=texts(v, "$.quality_notes"),
    )


def structure_records(items: DataFrame) -> DataFrame:
    """Key families. Without a description the texts of all annotations, in order, stand for it."""
    v = F.col("v")
    key = text_at(v, "$.id", "$.agencyid")
    notes = F.array_join(F.filter(F.transform(listed(v, "$.annotations.annotation"), lambda a: value_at(a, "$.annotationtext")), F.isnotnull), " ")
    return mapped(
        items, "structures", "Structure Dataset", native_id=key, title=F.coalesce(value_at(v, "$.name"), key), notes=F.coalesce(F.nullif(plain_text(text_at(v, "$.description")), F.lit("")), notes),
        url=F.concat(F.lit(f"{STRUCTURES}/dataset/"), key, F.lit(".overview.json")), topics=texts(v, "$.keywords"), tags=F.array(F.lit("nomis"), F.lit("sdmx")), state=F.lit("published"),
        selection_arguments=F.create_map(F.lit("dataset"), key, F.lit("format"), F.lit("sdmx")), query_tool=F.lit(STRUCTURE_QUERY), binding_status=F.lit("available"),
    )


def geography_records(items: DataFrame) -> DataFrame:
    """Features of a map catalogue; where there are several names for a property, the first that has a value counts."""
    v = F.col("v")
    p = lambda *names: text_at(v, *(f"$.properties.{n}" for n in names))
    key = F.coalesce(text_at(v, "$.id"), p("id"))
    title = F.coalesce(p("title", "name"), key)
    words = F.when(F.size(texts(v, "$.properties.keywords")) > 0, texts(v, "$.properties.keywords")).otherwise(texts(v, "$.properties.tags"))
    box = F.coalesce(F.try_variant_get(v, "$.bbox", "array<double>"), F.try_variant_get(v, "$.properties.bbox", "array<double>"))
    own = F.nullif(plain_text(p("description")), F.lit(""))
    place = lambda name: F.when(F.size(texts(v, f"$.properties.{name}")) > 0, texts(v, f"$.properties.{name}"))
    return mapped(
        items, "geography", "Geography Dataset", native_id=key, title=title, notes=F.coalesce(own, plain_text(p("snippet", "summary"))), url=F.coalesce(p("url", "landingPage", "landing_page"), F.concat(F.lit(f"{GEOGRAPHY}/datasets/"), key)),
        topics=F.when(F.size(words) > 0, words).otherwise(F.array(F.lit("Geography"))), tags=F.concat(words, F.array(F.lit("open-geography"))), state=F.coalesce(p("status"), F.lit("published")), frequency=cadence(own),
        geography=F.coalesce(place("geography"), place("spatial"), place("coverage"), F.array().cast("array<string>")), geography_vintage=title_year(title), area_served=area_served(words), bbox=F.when(F.size(box) >= 4, F.slice(box, 1, 4)),
        metadata_modified=F.coalesce(p("modified", "updated", "modified_at"), text_at(v, "$.time")), access_model=F.when(F.lower(p("access")) == "public", "public"), binding_status=F.lit("planned"),
    )


def finalised(records: DataFrame, snapshot_id: str) -> DataFrame:
    """Records with what all lanes get: provenance with the time that it stands at and what says so, identity, publication and statistical description.

    ``records`` has, beside the lanes' columns, ``retrieved_at`` and ``commit_as_of``. Without quality notes the links to methods and quality stand for them.
    """
    seen, made = F.nullif("retrieved_at", F.lit("")), F.nullif("commit_as_of", F.lit(""))
    basis = F.when(seen.isNotNull(), "provenance.retrieved_at").when(made.isNotNull(), "provenance.source_commit_as_of").otherwise("not-evidenced")
    notes = F.when(F.size("quality_notes") > 0, F.col("quality_notes")).otherwise(text_list(F.concat("methodology_links", "quality_links")))
    blank = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return records.withColumns(
        {
            "provenance": F.struct(F.lit(snapshot_id).alias("snapshot_id"), "native_id", F.coalesce(seen, made, F.lit("")).alias("source_as_of"), basis.alias("source_as_of_basis")),
            "identity": F.struct(F.col("native_id").alias("dataset_id"), blank("latest_edition"), blank("latest_version")),
            "publication": F.struct(blank("state"), blank("metadata_modified")),
            "statistical": F.struct(blank("population_type"), blank("frequency"), "geography", notes.alias("quality_notes")),
        }
    )
