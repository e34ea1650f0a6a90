"""Queries over nested documents, one for each order or vector; a shared expression makes a document for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import variants
from cairn.plans.registry import query
from cairn.sources.records import table

WANTED = ("total_price", "value")
#: A price below none to three lists, as a number or a text, beside another that is a number for every fifth order.
PRICED = """concat('{"id":', CAST(o_orderkey AS STRING), ',"nest":', repeat('{"b":[', CAST(o_orderkey % 4 AS INT)), '{"Total-Price":', CASE WHEN o_orderkey % 3 = 0 THEN concat('" ', CAST(o_custkey AS STRING), '.50 "') ELSE CAST(o_custkey AS STRING) END, ',"note":"x"}',
 repeat(']}', CAST(o_orderkey % 4 AS INT)), ',"other":{"total_price":', CASE o_orderkey % 5 WHEN 0 THEN '7' WHEN 1 THEN '"none"' WHEN 2 THEN '"0x10"' WHEN 3 THEN 'true' ELSE 'null' END, '}}')"""


def documents(spark: SparkSession, sf_dir: str, source: str, key: str, text: str) -> DataFrame:
    return table(spark, sf_dir, source).select(key, F.parse_json(F.expr(text)).alias("doc"))


@query(
    """WITH o AS (SELECT o_orderkey, o_orderkey % 4 AS n, o_orderkey % 5 AS m, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey + 0.5 ELSE o_custkey END::DOUBLE AS own FROM orders)
    SELECT o_orderkey, CASE WHEN n = 0 THEN own WHEN m = 0 THEN 7 WHEN m = 2 THEN 16 WHEN n <= 2 THEN own END AS number FROM o"""
)
def wanted_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first number called total price or value, five levels down at most."""
    return variants.first_number(documents(spark, sf_dir, "orders", "o_orderkey", PRICED), "o_orderkey", "doc", WANTED)


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 7 WHEN 2 THEN 16 END::DOUBLE AS number FROM orders")
def numbers_at_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "orders", "o_orderkey", PRICED)
    return docs.select("o_orderkey", variants.number_at(F.col("doc"), ("other", "total_price")).alias("number"))


POINT = "concat('[', CAST(CAST(floor(CAST({x} AS DOUBLE) * 100000) AS INT) % {w} AS STRING), '.5,', CAST(CAST(floor(CAST({y} AS DOUBLE) * 100000) AS INT) % 90 AS STRING), '{more}]')"
#: Three points under one to four lists, with things that are no points; of the label 3 some lie off the globe.
COORDINATES = "concat(repeat('[', 1 + label % 4), {}, ',[true,4],[\"5\",6],[7],[],null,', {}, repeat(']', 1 + label % 4), '')"


def coordinates(element: str) -> str:
    """The expression, with ``element`` telling how a component of the vector is written."""
    e = lambda i: element.format(i=i)
    width = "CASE label WHEN 3 THEN 400 ELSE 180 END"
    return COORDINATES.format(POINT.format(x=e(1), y=e(2), w=width, more=""), f"concat('[', {POINT.format(x=e(3), y=e(4), w=width, more=',9')}, ',[', {POINT.format(x=e(5), y=e(6), w=width, more='')}, ']]')")


X, Y = ("CAST(floor(CAST(embedding[{}] AS DOUBLE) * 100000) AS INT) % CASE label WHEN 3 THEN 400 ELSE 180 END", "CAST(floor(CAST(embedding[{}] AS DOUBLE) * 100000) AS INT) % 90")
#: A text like -0.5 stands for the numbers between 0 and -1: a remainder of nought has no sign.
SIGNED = "CASE WHEN {0} < 0 THEN {0} - 0.5 ELSE {0} + 0.5 END"


@query(
    "WITH p AS (SELECT vec_id, "
    + ", ".join(f"({SIGNED.format(X.format(a))})::DOUBLE AS x{a}, ({Y.format(a + 1)})::DOUBLE AS y{a}" for a in (1, 3, 5))
    + " FROM embeddings) SELECT vec_id, least(x1, x3, x5) AS west, least(y1, y3, y5) AS south, greatest(x1, x3, x5) AS east, greatest(y1, y3, y5) AS north FROM p WHERE greatest(abs(x1), abs(x3), abs(x5)) <= 180"
)
def nested_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extents of the points in nested coordinates; documents with a point off the globe have none."""
    docs = documents(spark, sf_dir, "embeddings", "vec_id", coordinates("embedding[{i} - 1]"))
    return variants.points_extent(variants.numeric_points(docs, "vec_id", "doc"), "vec_id")


#: Arrays of one, two or no elements called items or results, at the top, further down, or behind an empty one.
COLLECTED = """concat('{"a":{"deep":{"items":[1,2]}},"b":{"items":[', CASE WHEN c_custkey % 3 = 0 THEN '3' ELSE '' END, '],"inner":{"results":[4,5,6]}},"c":{"results":[7,8,9,10]}',
 CASE c_custkey % 4 WHEN 0 THEN ',"results":[]' WHEN 1 THEN ',"results":[11],"items":[12,13,14,15,16]' WHEN 2 THEN ',"items":{"results":0}' ELSE '' END, '}')"""


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 5 ELSE 2 END AS n FROM customer")
def first_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = variants.first_collection(documents(spark, sf_dir, "customer", "c_custkey", COLLECTED), "c_custkey", "doc", ("items", "results"))
    return found.select("c_custkey", F.size("items").alias("n"))


UNORDERED = """concat('{"b":', props, ',"A":{"d":', CAST(event_id AS STRING), ',"C":[{"z":null,"Y":"q\\\\"uote"},[],{}]},"a":true,"', event_type, '":[', CAST(event_id % 7 AS STRING), ']}')"""


@query(
    r"""SELECT event_id, concat('{"A":{"C":[{"Y":"q\"uote","z":null},[],{}],"d":', event_id, '},"a":true,"b":', x, ',"', event_type, '":[', event_id % 7, ']}') AS text
    FROM (SELECT *, concat('{', (SELECT string_agg(concat('"', key, '":', value), ',' ORDER BY lower(key)) FROM json_each(props::JSON)), '}') AS x FROM events)"""
)
def canonical_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON with names in order whatever their case. The names of their types come after b."""
    return variants.canonical_text(documents(spark, sf_dir, "events", "event_id", UNORDERED), "event_id", "doc")
