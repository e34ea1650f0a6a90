"""Adapters that turn raw JSON pages of three kinds of catalogue into rows of one projection.

Each adapter takes (page, payload) rows, with the payload as a variant, and tolerates an object where a list is
usual. Unknown keys don't survive: only what is named here is read. Rows without an id or a title are left out, and
``raw_counts`` tells how many rows pages held before that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.text import safe_public_url
from cairn.functions.values import bbox_extent, epoch_timestamp, text_list

PROJECTION = ("page", "id", "title", "description", "modified", "licence", "url", "keywords", "dimensions", "extent")
EXTENT = "struct<west:double,south:double,east:double,north:double>"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page, payload): whole files of JSON, one page each."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("page"), F.try_parse_json("value").alias("payload"))
    return files


def listed(value: Column, path: str) -> Column:
    """Elements at a path as variants: those of a list, a lone object as a list of one, nothing as an empty list."""
    many = F.try_variant_get(value, path, "array<variant>")
    one = F.try_variant_get(value, path, "variant")
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<variant>"))


def text_at(value: Column, *paths: str) -> Column:
    """First non-blank text at one of the paths."""
    return F.coalesce(*(F.nullif(F.trim(F.try_variant_get(value, p, "string")), F.lit("")) for p in paths))


def value_at(value: Column, path: str) -> Column:
    """The text at a path, or the value, text or name of an object there."""
    own = text_at(value, path)
    return F.coalesce(text_at(value, f"{path}.value", f"{path}.text", f"{path}.name"), F.when(~own.startswith("{"), own))


def projected(rows: DataFrame, **columns: Column) -> DataFrame:
    empty = {"dimensions": F.array().cast("array<string>"), "keywords": F.array().cast("array<string>"), "extent": F.lit(None).cast(EXTENT)}
    out = rows.select(*(columns.get(c, empty.get(c, F.lit(None).cast("string"))).alias(c) for c in PROJECTION))
    out = out.withColumn("url", F.when(safe_public_url(F.col("url")), F.col("url")))
    return out.where("id IS NOT NULL AND title IS NOT NULL")


def items(pages: DataFrame, *paths: str) -> DataFrame:
    found = F.array().cast("array<variant>")
    for p in reversed(paths):
        own = listed(F.col("payload"), p)
        found = F.when(F.size(own) > 0, own).otherwise(found)
    return pages.select("page", F.explode(found).alias("v"))


def texts(value: Column, path: str) -> Column:
    """Sorted distinct texts of a list, or of a text parted by commas, semicolons or bars."""
    many = F.try_variant_get(value, path, "array<string>")
    return text_list(F.coalesce(many, F.split(F.try_variant_get(value, path, "string"), "[,;|]"), F.array().cast("array<string>")))


def catalogue(pages: DataFrame) -> DataFrame:
    """Items of a catalogue's pages, under ``items`` or ``results``."""
    v = F.col("v")
    return projected(
        items(pages, "$.items", "$.results"), page=F.col("page"), id=text_at(v, "$.id"), title=text_at(v, "$.title"), description=text_at(v, "$.description"), modified=text_at(v, "$.last_updated"),
        licence=text_at(v, "$.license"), url=text_at(v, "$.links.self.href", "$.qmi.href"), keywords=texts(v, "$.keywords"),
    )


def key_families(pages: DataFrame) -> DataFrame:
    """Key families of SDMX structure pages; components keep their order."""
    v = F.col("v")
    notes = F.transform(listed(v, "$.annotations.annotation"), lambda a: F.struct(F.try_variant_get(a, "$.annotationtitle", "string").alias("k"), F.try_variant_get(a, "$.annotationtext", "string").alias("t")))
    note = lambda k: F.get(F.filter(notes, lambda a: a["k"] == k), 0)["t"]
    concepts = F.transform(listed(v, "$.components.dimension"), lambda d: F.coalesce(F.try_variant_get(d, "$.conceptref", "string"), F.lit("")))
    return projected(
        items(pages, "$.structure.keyfamilies.keyfamily"), page=F.col("page"), id=text_at(v, "$.id"), title=value_at(v, "$.name"),
        description=F.coalesce(text_at(v, "$.description.value"), note("MetadataText0"), note("contenttype/sources")), modified=note("LastUpdated"), keywords=text_list(F.split(note("Keywords"), ",")), dimensions=concepts,
    )


def features(pages: DataFrame) -> DataFrame:
    """Features of GeoJSON pages, without their geometry; times are epoch milliseconds, an extent is two corners on the globe."""
    v = F.col("v")
    corners = F.try_variant_get(v, "$.properties.extent", "array<array<double>>")
    extent = bbox_extent(F.transform(corners, lambda c: F.struct(F.get(c, 0).alias("x"), F.get(c, 1).alias("y"))))
    modified = F.date_format(epoch_timestamp(F.try_variant_get(v, "$.properties.modified", "bigint")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return projected(
        items(pages, "$.features"), page=F.col("page"), id=text_at(v, "$.id"), title=text_at(v, "$.properties.title"), description=text_at(v, "$.properties.description"), modified=modified,
        licence=text_at(v, "$.properties.licenseInfo"), url=text_at(v, "$.properties.url"), keywords=texts(v, "$.properties.tags"), extent=extent,
    )


def raw_counts(pages: DataFrame, *paths: str) -> DataFrame:
    """(page, seen): rows on each page before any is left out."""
    return items(pages, *paths).groupBy("page").agg(F.count(F.lit(1)).alias("seen"))


def first_by_id(rows: DataFrame) -> DataFrame:
    """Of rows with one id on several pages the first page's."""
    least = rows.groupBy("id").agg(F.min(F.struct("page", *(c for c in PROJECTION if c not in ("page", "id")))).alias("r"))
    return least.select("r.page", "id", *(f"r.{c}" for c in PROJECTION if c not in ("page", "id")))
