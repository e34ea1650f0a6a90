"""Queries over how fields of records came about."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import derivations
from cairn.plans import sql
from cairn.plans.registry import query
from cairn.sources.records import records, table

#: rank, condition, field, key, value: what three sources say of a record. The texts are expressions of Spark and of SQL alike.
CLAIMS = [
    (1, "publisher_title IS NOT NULL", "publisher", "mode", "'declared'"), (1, "publisher_title IS NOT NULL", "publisher", "from", "record_type"), (1, "license_id IS NOT NULL", "license", "mode", "'declared'"),
    (2, "url IS NOT NULL", "publisher", "mode", "'extracted <b>from</b> pages'"), (2, "url IS NOT NULL", "publisher", "note", "'page'"), (2, "license_id IS NOT NULL", "license", "mode", "'extracted'"),
    (2, "license_id IS NOT NULL", "license", "text", "license_id"), (3, "true", "title", "mode", "CASE WHEN title IS NULL THEN '  ' ELSE 'inferred' END"), (3, "true", "publisher", "basis", "source_surface"),
    (3, "true", "publisher", "mode", "'guessed'"), (3, "true", "measure", "mode", "coalesce(measure, '')"),
]
GIVEN = {1: "[]", 2: "[]", 3: "['legacy', '  ', 'declared']"}


def claims(rows: DataFrame) -> list[DataFrame]:
    """A table of parts for each source."""
    out = []
    for rank in (1, 2, 3):
        own = [c for c in CLAIMS if c[0] == rank]
        names = list(dict.fromkeys(c[2] for c in own))
        details = {n: F.map_from_entries(F.filter(F.array(*(F.when(F.expr(c[1]), F.struct(F.lit(c[3]).alias("key"), F.expr(c[4]).alias("value"))) for c in own if c[2] == n)), F.isnotnull)) for n in names}
        fields = F.map_filter(F.create_map(*(x for n in names for x in (F.lit(n), details[n]))), lambda _, v: F.size(v) > 0)
        modes = F.array(*map(F.lit, ("legacy", "  ", "declared"))) if rank == 3 else F.array().cast("array<string>")
        out.append(rows.select("id", F.lit(rank).alias("rank"), modes.alias("modes"), fields.alias("fields")))
    return out


CLAIMS_SQL = f"""WITH {sql.records()}, c AS ({' UNION ALL '.join(f"SELECT id, {rank} AS rank, '{field}' AS field, '{key}' AS key, {value} AS value FROM r WHERE {test}" for rank, test, field, key, value in CLAIMS)}),
first AS (SELECT id, field, key, arg_min(value, rank) AS value FROM c GROUP BY ALL),
m AS (SELECT id, {sql.plain('value', derivations.MODE)} AS mode FROM first WHERE key = 'mode' UNION SELECT id, unnest(['legacy', 'declared']) FROM r)
SELECT f.id, modes, fields FROM (SELECT id, string_agg(field || '.' || key || '=' || value, ';' ORDER BY field, key) AS fields FROM first GROUP BY id) f
JOIN (SELECT id, string_agg(DISTINCT mode, ',' ORDER BY mode) AS modes FROM m WHERE mode <> '' GROUP BY id) USING (id)"""


@query(CLAIMS_SQL)
def field_derivations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three sources say of the fields of all records, put together; the lines of a record come from the last source first."""
    parts = reduce(DataFrame.unionAll, reversed(claims(records(spark, sf_dir))))
    merged = derivations.merge(parts)
    lines = F.flatten(F.transform(F.map_entries("fields"), lambda f: F.transform(F.map_entries(f["value"]), lambda d: F.struct(f["key"].alias("field"), d["key"].alias("key"), d["value"].alias("value")))))
    text = F.array_join(F.transform(F.array_sort(lines), lambda x: F.concat(x["field"], F.lit("."), x["key"], F.lit("="), x["value"])), ";")
    return merged.select("id", F.array_join("modes", ",").alias("modes"), text.alias("fields"))


NESTED = """concat('{"a":{"b":', CASE c_custkey % 4 WHEN 0 THEN '"found"' WHEN 1 THEN '"None"' WHEN 2 THEN 'null' ELSE '{}' END, '},"c":', CASE WHEN c_custkey % 3 = 0 THEN '"  "' ELSE concat('"', c_mktsegment, '"') END, ',"d":[1]}')"""


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'found' WHEN c_custkey % 4 = 3 THEN '{}' WHEN c_custkey % 3 = 0 THEN '  ' ELSE c_mktsegment END AS value FROM customer")
def fallback_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of three paths that leads to more than a gap."""
    docs = table(spark, sf_dir, "customer").select("c_custkey", F.parse_json(F.expr(NESTED)).alias("doc"))
    return docs.select("c_custkey", derivations.fallback(F.col("doc"), ("a", "b"), ("a", "missing", "b"), ("c",), ("d",)).alias("value"))
