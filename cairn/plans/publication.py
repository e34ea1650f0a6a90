"""Queries over snapshots of shards that are published, read back and checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.plans import sql
from cairn.plans.registry import query
from cairn.scratch import scratch_path
from cairn.sources import shards
from cairn.sources.records import LANES, corpus

CONTEXT = "https://schema.example/context"
ABOUT_SQL = "list_filter(list_concat(list_concat(topics, tags), area_served), lambda x: x IS NOT NULL)"
NODES_SQL = f"""WITH {sql.corpus()}, n AS (SELECT ordinal, id, len({ABOUT_SQL}) AS triples, '{{"@id":"' || id || '","about":[' || array_to_string(list_transform({ABOUT_SQL}, lambda t: '{{"@id":"' || t || '"}}'), ',') || ']}}' AS node FROM c)"""


def nodes(spark: SparkSession, sf_dir: str, *lanes: str) -> DataFrame:
    """(ordinal, node, triples): records as nodes that link to their topics, tags and areas."""
    about = F.array_compact(F.concat("topics", "tags", "area_served"))
    linked = F.array_join(F.transform(about, lambda t: F.concat(F.lit('{"@id":"'), t, F.lit('"}'))), ",")
    return corpus(spark, sf_dir, *lanes).select("ordinal", F.concat(F.lit('{"@id":"'), "id", F.lit('","about":['), linked, F.lit("]}")).alias("node"), F.size(about).cast("bigint").alias("triples"))


@query(
    NODES_SQL + f""", s AS (SELECT ordinal // {shards.SHARD} AS shard, count(*) AS nodes, CAST(sum(triples) AS BIGINT) AS triples, '{{"@context":"{CONTEXT}","@graph":[' || string_agg(node, ',' ORDER BY ordinal) || ']}}' AS text FROM n GROUP BY 1)
    SELECT shard, nodes, triples, strlen(text) AS text_bytes, sha256(text) AS text_sha256 FROM s"""
)
def published_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions of a published snapshot of all records, by the tasks that wrote it."""
    path = scratch_path(spark, "published")
    shards.publish(nodes(spark, sf_dir), path, CONTEXT)
    return shards.described(spark, path).select("shard", "nodes", "triples", "text_bytes", "text_sha256")


REMAINING = tuple(x for x in LANES if x != "parts")


@query(NODES_SQL.replace(sql.corpus(), sql.corpus(*REMAINING)) + f" SELECT ordinal // {shards.SHARD} AS shard, CAST(ordinal % {shards.SHARD} AS INTEGER) AS place, id, triples FROM n")
def republished_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes read back after a second snapshot, without parts, took the place of the first."""
    path = scratch_path(spark, "published")
    for lanes in ((), REMAINING):
        shards.publish(nodes(spark, sf_dir, *lanes), path, CONTEXT)
    back = shards.published(spark, path)
    return back.select("shard", F.col("at").alias("place"), F.try_variant_get("node", "$['@id']", "string").alias("id"), F.size(F.try_variant_get("node", "$.about", "array<variant>")).cast("bigint").alias("triples"))
