"""Queries over schemas and assertions: one schema for each part, one assertion for each line item."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import schemas
from cairn.plans import sql
from cairn.plans.registry import query
from cairn.sources.records import table

#: name of a place in a schema: (JSON around a keyword that isn't known, its path).
PLACES = {
    "top": ('{{"type":"object","{0}":1}}', "$"), "property": ('{{"properties":{{"a":{{"{0}":1}},"{0}":{{"type":"string"}}}}}}', "$.properties['a']"), "definition": ('{{"$defs":{{"d":{{"items":{{"{0}":1}}}}}}}}', "$.$defs['d'].items"),
    "then": ('{{"if":{{"const":1}},"then":{{"{0}":1}}}}', "$.then"), "list": ('{{"oneOf":[{{"type":"string"}},{{"allOf":[true,{{"{0}":1}}]}}]}}', "$.oneOf[1].allOf[1]"), "more": ('{{"additionalProperties":{{"properties":{{"b":{{"{0}":1}}}}}}}}', "$.additionalProperties.properties['b']"),
    "constant": ('{{"const":{{"{0}":1}},"enum":[{{"{0}":1}}],"additionalProperties":false}}', None),
}
WORDS = ("maxLength", "not", "dependentSchemas")
K = "p_partkey"
WORD = f"CASE {K} % 3 WHEN 0 THEN '{WORDS[0]}' WHEN 1 THEN '{WORDS[1]}' ELSE '{WORDS[2]}' END"


def schema_text() -> str:
    """Spark's expression for a part's schema."""
    cases = " ".join(f"WHEN {n} THEN replace('{text.format('#')}', '#', {WORD})" for n, (text, _) in enumerate(PLACES.values()))
    return f"CASE {K} % {len(PLACES)} {cases} END"


@query(
    f"SELECT {K}, path, {WORD} AS keyword FROM part JOIN (VALUES "
    + ", ".join("({}, '{}')".format(n, path.replace("'", "''")) for n, (_, path) in enumerate(PLACES.values()) if path) + f") v(n, path) ON n = {K} % {len(PLACES)}"
)
def schema_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords that the validator doesn't know, in every place where a schema may stand."""
    own = table(spark, sf_dir, "part").select(K, F.parse_json(F.expr(schema_text())).alias("doc"))
    return schemas.unknown_keywords(own, K, "doc")


PINS = {str(k): hashlib.sha256(f'{{"title":"part {k}"}}'.encode()).hexdigest() for k in range(0, 100, 2)}


@query(
    f"""WITH s AS (SELECT {K}, sha256('{{"title":"part ' || CASE WHEN {K} % 7 = 0 THEN {K} + 1 ELSE {K} END || '"}}') AS digest, CASE WHEN {K} < 100 AND {K} % 2 = 0 THEN sha256('{{"title":"part ' || {K} || '"}}') END AS expected FROM part)
    SELECT CAST({K} AS VARCHAR) AS {K}, digest, expected FROM s WHERE digest IS DISTINCT FROM expected"""
)
def schema_pins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas of parts that aren't the pinned ones."""
    number = F.when(F.col(K) % 7 == 0, F.col(K) + 1).otherwise(F.col(K))
    return schemas.pinned(table(spark, sf_dir, "part").select(K, F.format_string('{"title":"part %d"}', number).alias("text")), K, "text", PINS)


ASSERTION = {
    "type": "object", "required": ["@id", "source", "target", "status"],
    "properties": {"@id": {"type": "string", "pattern": "^urn:"}, "source": {"type": "string", "minLength": 1}, "target": {"type": "object", "required": ["@id"]}, "status": {"enum": ["declared", "inferred"]}},
}
L = "l_orderkey * 10 + l_linenumber"
ID = f"concat(CASE WHEN l_partkey % 37 = 5 THEN 'x:' ELSE 'urn:' END, CAST(CASE WHEN l_linenumber = 2 AND l_orderkey % 11 = 4 THEN {L} - 1 ELSE {L} END AS STRING))"
MADE = f"""concat('{{"@id":"', {ID}, '","source":"', CASE WHEN l_suppkey % 7 = 1 THEN '' ELSE 's' END, '"', CASE WHEN l_partkey % 41 = 2 THEN '' ELSE concat(',"target":', CASE WHEN l_partkey % 43 = 3 THEN '{{}}' ELSE '{{"@id":"t"}}' END) END, ',"status":"', CASE WHEN l_partkey % 47 = 6 THEN 'certified' ELSE 'declared' END, '"}}')"""


def assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as assertions of two planes; the runtime plane lacks those of returned items. Each is read and parsed once."""
    planes = F.when(F.col("l_returnflag") != "R", F.array(F.lit("semantic"), F.lit("runtime"))).otherwise(F.array(F.lit("semantic")))
    return table(spark, sf_dir, "lineitem").select(planes.alias("planes"), F.parse_json(F.expr(MADE)).alias("doc"))


PLANES_SQL = f"""l AS (SELECT *, {ID} AS id FROM lineitem), p AS (SELECT 'semantic' AS plane, * FROM l UNION ALL SELECT 'runtime', * FROM l WHERE l_returnflag <> 'R')"""


@query(
    f"""WITH {PLANES_SQL} SELECT plane, id, 'identity occurs twice' AS rule FROM p GROUP BY plane, id HAVING count(*) > 1
    UNION ALL SELECT DISTINCT plane, id, unnest(list_filter([CASE WHEN l_partkey % 37 = 5 THEN '$.@id:pattern' END, CASE WHEN l_suppkey % 7 = 1 THEN '$.source:minLength' END, CASE WHEN l_partkey % 41 = 2 THEN '$:required target' END,
     CASE WHEN l_partkey % 43 = 3 AND l_partkey % 41 <> 2 THEN '$.target:required @id' END, CASE WHEN l_partkey % 47 = 6 THEN '$.status:enum' END], lambda x: x IS NOT NULL)) AS rule FROM p"""
)
def assertion_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.assertion_faults(assertions(spark, sf_dir), ASSERTION)


@query(f"WITH {PLANES_SQL}, hashed AS (SELECT plane, sha256(id) AS h FROM p), {sql.set_digest('plane', 'hashed')} SELECT plane, n, digest FROM digests")
def assertion_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.identity_sets(assertions(spark, sf_dir))
