"""Lanes of heterogeneous tables, normalised to one record schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.text import plain_text, public_host, slug
from cairn.scratch import broadcast_if, materialize

COLUMNS = {
    "id": "string", "native_id": "string", "name": "string", "title": "string", "notes": "string", "record_type": "string", "source_surface": "string", "route": "string",
    "url": "string", "host": "string", "topics": "array<string>", "tags": "array<string>", "publisher_title": "string", "license_id": "string", "state": "string",
    "frequency": "string", "population_type": "string", "measure": "string", "unit_of_measure": "string", "area_served": "array<string>", "quality_notes": "array<string>",
    "methodology_links": "array<string>", "metadata_modified": "string", "declared_code": "string", "context_note": "string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shaped(rows: DataFrame, **given: Column) -> DataFrame:
    """One record for each row: the given columns, and nulls or empty lists for the others."""
    empty = {c: F.array().cast(k) if k.startswith("array") else F.lit(None).cast(k) for c, k in COLUMNS.items()}
    empty["name"] = slug(given["id"], markup=False)
    empty["route"] = F.concat(F.lit("record/"), empty["name"])
    return rows.select(*((given[c] if c in given else empty[c]).cast(k).alias(c) for c, k in COLUMNS.items()))


def lane_id(lane: str, key: Column) -> Column:
    return F.concat(F.lit(lane + ":"), key.cast("string"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    text = F.col("text")
    note = F.when(F.col("quality").isNotNull(), F.array(F.concat(F.lit("labelled quality "), F.col("quality").cast("string")))).otherwise(F.array())
    return shaped(
        rows, id=lane_id("documents", F.col("doc_id")), native_id=F.col("doc_id"), title=F.left(F.split_part(text, F.lit("\n"), F.lit(1)), F.lit(1000)), notes=text,
        record_type=F.lit("Document"), source_surface=F.lit("documents"), topics=F.array(F.col("lang")), publisher_title=F.col("source"),
        license_id=F.nullif(F.regexp_extract(text, r"Licensed under (?:the )?([A-Z][A-Za-z0-9 -]*)", 1), F.lit("")), quality_notes=note,
        state=F.when(F.col("toxic") == 1, "restricted").when(F.col("toxic") == 0, "published"), metadata_modified=F.lit(None),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return shaped(
        table(spark, sf_dir, "pages"), id=lane_id("pages", F.col("page_id")), native_id=F.col("page_id"), title=plain_text(F.regexp_extract(html, "(?is)<title>(.*?)</title>", 1), 1000),
        notes=plain_text(html), record_type=F.lit("Page"), source_surface=F.lit("pages"), topics=F.array(F.regexp_extract(html, '<html lang="([a-z]*)"', 1)), url=F.col("url"),
        host=public_host(F.col("url")), publisher_title=public_host(F.col("url")),
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(
        table(spark, sf_dir, "part"), id=lane_id("parts", F.col("p_partkey")), native_id=F.col("p_partkey"), title=F.col("p_name"), record_type=F.lit("Part"), source_surface=F.lit("parts"),
        tags=F.array("p_brand", "p_type"), unit_of_measure=F.col("p_size"), measure=F.col("p_type"), publisher_title=F.col("p_brand"), declared_code=F.concat_ws("-", "p_brand", F.col("p_size").cast("string")),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their regions. Spark broadcasts them by the size of their files."""
    region = table(spark, sf_dir, "region")
    return table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").join(places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
    return shaped(
        rows, id=lane_id("suppliers", F.col("s_suppkey")), native_id=F.col("s_suppkey"), title=F.col("s_name"), record_type=F.lit("Supplier"), source_surface=F.lit("suppliers"),
        topics=F.array("n_name"), area_served=F.array("r_name"), publisher_title=F.col("n_name"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").join(places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    return shaped(
        rows, id=lane_id("customers", F.col("c_custkey")), native_id=F.col("c_custkey"), title=F.col("c_name"), record_type=F.lit("Customer"), source_surface=F.lit("customers"),
        topics=F.array("c_mktsegment"), area_served=F.array("r_name"), publisher_title=F.col("n_name"), population_type=F.col("c_mktsegment"),
    )


LANES = {"documents": documents, "pages": pages, "parts": parts, "suppliers": suppliers, "customers": customers}


def records(spark: SparkSession, sf_dir: str, *lanes: str) -> DataFrame:
    """The union of the lanes; all of them if none is named."""
    return reduce(DataFrame.unionByName, (LANES[x](spark, sf_dir) for x in lanes or LANES))


def first_of_each(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Of rows with equal, non-blank keys the first in the given order: a grouped minimum, no window over a group."""
    rest = [c for c in rows.columns if c not in order]
    kept = rows.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(F.col(key).alias("_key")).agg(F.min(F.struct(*order, *rest)).alias("_row"))
    return kept.select(*(F.col("_row")[c].alias(c) for c in rows.columns))


def repeated_keys(rows: DataFrame, key: str) -> DataFrame | None:
    """Keys that more than one row has; none if there is no such key. Stored, since what is made of rows depends on it."""
    twice = materialize(rows.groupBy(F.col(key).alias("_again")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_again"), "repeated")
    return None if twice.isEmpty() else broadcast_if(twice, 200_000, cheap=True)


def once(rows: DataFrame, key: str, again: DataFrame | None, *order: str) -> DataFrame:
    """``first_of_each``, but only rows whose keys are repeated are grouped; the others stay where they are read."""
    named = rows.where(F.col(key).isNotNull() & (F.col(key) != ""))
    if again is None:
        return named
    same = F.col(key) == F.col("_again")
    return named.join(again, same, "left_anti").unionByName(first_of_each(named.join(again, same, "left_semi"), key, *order))


def with_ordinal(rows: DataFrame, *order: Column, name: str = "ordinal") -> DataFrame:
    """Dense numbers from 0 in the given order: rows are dealt by ranges, numbered within each, and shifted by the sizes of the ranges before."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt = materialize(dealt, "ordered")
    size = dealt.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sorted((r["_part"], r["_n"]) for r in size.collect())  # one row for each range
    begins, total = [], 0
    for part, n in sizes:
        begins.append((part, total))
        total += n
    starts = dealt.sparkSession.createDataFrame(begins, "_part bigint, _start bigint")
    both = dealt.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(starts), "_part")
    return both.withColumn(name, F.col("_start") + F.col("_at") - F.shiftleft("_part", 33)).drop("_at", "_part", "_start")


def corpus_order() -> list[Column]:
    return [F.col("source_surface"), F.lower("title"), F.col("id")]


def corpus_of(own: DataFrame) -> DataFrame:
    """Records once per id, of repeated ones the first in the order of their columns, with their place in the corpus as ``ordinal``.

    Only ids and what orders them are numbered, never whole texts, and columns that nobody asks for are neither read nor shuffled, but for records whose ids are repeated.
    """
    again, order = repeated_keys(own, "id"), ("source_surface", "title")
    places = with_ordinal(once(own.select(*order, "id"), "id", again, *order), *corpus_order()).select("id", "ordinal")
    return once(own, "id", again, *order).join(broadcast_if(places, 200_000, cheap=True), "id")


def distinct_records(own: DataFrame) -> DataFrame:
    """Records once per id, as in ``corpus_of``, without places."""
    return once(own, "id", repeated_keys(own, "id"), "source_surface", "title")


def corpus(spark: SparkSession, sf_dir: str, *lanes: str) -> DataFrame:
    """All records once, in their order."""
    return corpus_of(records(spark, sf_dir, *lanes))
