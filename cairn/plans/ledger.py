"""Queries over coverage, digests, snapshots, sequences and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.values import bbox_extent as extent
from cairn.operators import ledger, validate
from cairn.plans import sql
from cairn.plans.registry import query
from cairn.sources.records import LANES, records, table


@query(
    f"""WITH {sql.records()}, p AS (SELECT source_surface AS source, CAST(native_id AS BIGINT) // 100 AS page, count(*) AS seen, count(*) FILTER (title IS NOT NULL AND length(title) > 8) AS normalised FROM r GROUP BY ALL)
    SELECT source, CAST(sum(normalised) AS BIGINT) AS represented, CAST(greatest(sum(seen) - sum(normalised), 0) AS BIGINT) AS dropped, CAST(greatest(any_value(reported) - sum(normalised), 0) AS BIGINT) AS unrepresented, bool_and(seen = normalised) AS complete FROM p JOIN (SELECT source_surface AS source, max(CAST(native_id AS BIGINT)) AS reported FROM r GROUP BY 1) USING (source) GROUP BY source"""
)
def coverage_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a hundred ids; rows with a title of eight characters or fewer count as dropped, and a source's greatest id tells how many rows it reports."""
    named = F.col("title").isNotNull() & (F.length("title") > 8)
    number = F.col("native_id").cast("long")
    rows = records(spark, sf_dir).groupBy(F.col("source_surface").alias("source"), F.floor(number / 100).alias("page"))
    return ledger.coverage(rows.agg(F.count(F.lit(1)).alias("seen"), F.count_if(named).alias("normalised"), F.max(number).alias("reported")))


@query("SELECT event_type, strftime(min(ts), '%Y-%m') AS first_month, strftime(max(ts), '%Y-%m') AS last_month, CAST(epoch_us(max(ts)) AS BIGINT) AS latest FROM events GROUP BY event_type")
def time_coverage_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ledger.month_extent(table(spark, sf_dir, "events"), "event_type", "ts")
    return found.withColumn("latest", F.unix_micros(F.col("latest").cast("timestamp")))


EPOCHS_SQL = "(SELECT event_id, 1600000000 + event_id * 977 AS value FROM events UNION ALL SELECT -event_id - 1, (1600000000 + event_id * 977) * 1000 + 250 FROM events)"


@query(f"SELECT event_id, strftime(make_timestamp(CASE WHEN value > 10000000000 THEN value // 1000 ELSE value END * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS at FROM {EPOCHS_SQL}")
def epoch_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds and milliseconds, told apart by their size."""
    own = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") * 977 + 1_600_000_000).alias("value"))
    both = own.unionAll(own.select(-F.col("event_id") - 1, F.col("value") * 1000 + 250))
    return ledger.normalised_epochs(both, "value").select("event_id", "at")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 3 = 0 THEN 'dotted ' || event_id WHEN event_id % 3 = 1 THEN 'nested ' || event_id END AS dotted, CAST(NULL AS VARCHAR) AS missing FROM events")
def json_path_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that holds the whole path goes before the path: of every three events one has both, one the path alone, one neither."""
    at = lambda doc, path, kind: F.coalesce(F.try_variant_get(doc, f"$['{path}']", kind), F.try_variant_get(doc, f"$.{path}", kind))
    number, id_ = F.col("event_id") % 3, F.col("event_id").cast("string")
    nested = F.when(number < 2, F.struct(F.concat(F.lit("nested "), id_).alias("b")))
    made = F.parse_json(F.to_json(F.struct(F.when(number == 0, F.concat(F.lit("dotted "), id_)).alias("a.b"), nested.alias("a"))))
    doc = F.try_parse_json("props")
    return table(spark, sf_dir, "events").select("event_id", at(doc, "k", "bigint").alias("k"), at(made, "a.b", "string").alias("dotted"), at(made, "a.c", "string").alias("missing"))


SECRET_SQL = ", ".join("CASE WHEN regexp_matches(text, '" + p.replace("'", "''") + f"') THEN '{k}' END" for k, p in validate.SECRETS.items())


@query(f"SELECT doc_id, array_to_string(list_filter([{SECRET_SQL}], lambda x: x IS NOT NULL), ',') AS kinds FROM documents WHERE len(list_filter([{SECRET_SQL}], lambda x: x IS NOT NULL)) > 0")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", validate.secret_kinds(F.col("text")).alias("kinds")).where(F.size("kinds") > 0)
    return found.withColumn("kinds", F.array_join("kinds", ","))


@query("WITH t AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS expected FROM conversations WHERE conv_id % 5 <> 0 OR turn <> 1), b AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY expected, turn) AS n FROM t WHERE turn <> expected) SELECT conv_id, expected, turn AS found FROM b WHERE n = 1")
def turn_sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations, of which every fifth lacks its second turn."""
    kept = table(spark, sf_dir, "conversations").where("conv_id % 5 <> 0 OR turn <> 1")
    return ledger.sequence_gaps(kept, "conv_id", "turn").withColumn("expected", F.col("expected").cast("long"))


DIFF_SQL = """WITH a AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 97 <> 0),
b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 31 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 89 <> 0),
d AS (SELECT o_orderkey, '*' AS field, CASE WHEN a.o_orderstatus IS NOT NULL THEN 'present' END AS old, CASE WHEN b.o_orderstatus IS NOT NULL THEN 'present' END AS new FROM a FULL JOIN b USING (o_orderkey) WHERE a.o_orderstatus IS NULL OR b.o_orderstatus IS NULL
 UNION ALL SELECT o_orderkey, 'o_orderstatus', a.o_orderstatus, b.o_orderstatus FROM a JOIN b USING (o_orderkey) WHERE a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
 UNION ALL SELECT o_orderkey, 'o_orderpriority', a.o_orderpriority, b.o_orderpriority FROM a JOIN b USING (o_orderkey) WHERE a.o_orderpriority IS DISTINCT FROM b.o_orderpriority)"""


def two_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    status = F.when(F.col("o_orderkey") % 31 == 0, "X").otherwise(F.col("o_orderstatus"))
    priority = F.when(F.col("o_orderkey") % 53 != 0, F.col("o_orderpriority"))
    after = own.where("o_orderkey % 89 <> 0").withColumns({"o_orderstatus": status, "o_orderpriority": priority})
    return ledger.snapshot_diff(own.where("o_orderkey % 97 <> 0"), after, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query(DIFF_SQL + " SELECT * FROM d")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_snapshots(spark, sf_dir)


@query(DIFF_SQL + " SELECT field, count(*) AS n FROM d WHERE field <> 'o_orderstatus' GROUP BY field")
def replacement_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes outside the one field that the replacement may touch."""
    return ledger.outside_allowlist(two_snapshots(spark, sf_dir), ["o_orderstatus"]).groupBy("field").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"WITH {sql.records()}, hashed AS (SELECT source_surface, sha256(id || '|' || coalesce(title, '')) AS h FROM r), {sql.set_digest('source_surface', 'hashed')} SELECT source_surface, n, digest FROM digests"
)
def checksum_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.set_digest(records(spark, sf_dir), "source_surface", F.concat_ws("|", "id", F.coalesce("title", F.lit(""))))


@query("SELECT p_partkey, sha256(CAST(p_partkey AS VARCHAR)) AS digest FROM part ORDER BY digest, p_partkey LIMIT 25")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.hash_sample(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey", 25)


RULES_SQL = {"priority": "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')", "price": "o_totalprice BETWEEN 1000 AND 400000", "status": "o_orderstatus <> 'P'", "date": "o_orderdate >= TIMESTAMP '1995-06-01'"}


@query(" UNION ALL ".join(f"SELECT o_orderkey, '{k}' AS rule FROM orders WHERE NOT coalesce({v}, false)" for k, v in RULES_SQL.items()))
def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.violations(table(spark, sf_dir, "orders"), "o_orderkey", {k: F.expr(v) for k, v in RULES_SQL.items()})


SCHEMA = {"type": "object", "required": ["k", "user"], "properties": {"k": {"type": "integer", "minimum": 10, "maximum": 80}, "user": {"type": "string", "minLength": 1}}}


@query("SELECT event_id, '$:required user' AS rule FROM events UNION ALL SELECT event_id, '$.k:minimum' FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) < 10 UNION ALL SELECT event_id, '$.k:maximum' FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) > 80")
def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("doc"))
    return validate.violations(rows, "event_id", validate.schema_rules(SCHEMA, F.col("doc")))


#: A schema with every keyword, and for each of its documents' defects the rule that it breaks. A document has the defect of its number modulo their count.
WHOLE_SCHEMA = {
    "type": "object", "required": ["id", "kind"], "additionalProperties": False, "definitions": {"tag": {"type": "string", "minLength": 2}},
    "properties": {
        "id": {"type": "string", "pattern": "^o[0-9]+$"}, "kind": {"enum": ["F", "O", "P"]}, "version": {"const": 2}, "at": {"type": "string", "format": "date-time"}, "url": {"type": "string", "format": "uri"},
        "tags": {"type": "array", "minItems": 1, "uniqueItems": True, "items": {"$ref": "#/definitions/tag"}}, "size": {"oneOf": [{"type": "integer", "minimum": 10}, {"type": "string"}, {"type": "integer", "maximum": 20}]},
        "open": {"type": "boolean"}, "note": {},
    },
    "allOf": [{"properties": {"note": {"type": "null"}}}], "if": {"properties": {"kind": {"const": "F"}, "open": {"const": True}}, "required": ["open"]}, "then": {"required": ["url"]},
}
#: name of a defect: (field, JSON in place of its value or nothing to leave it out, rule that this breaks)
DEFECTS = {
    "none": ("version", "2", ""), "no id": ("id", None, "$:required id"), "id of another form": ("id", '"x"', "$.id:pattern"), "id a number": ("id", "7", "$.id:type"), "kind": ("kind", '"Q"', "$.kind:enum"),
    "version": ("version", "3", "$.version:const"), "time": ("at", '"2024-01-01"', "$.at:format"), "uri": ("url", '"no uri"', "$.url:format"), "no tags": ("tags", "[]", "$.tags:minItems"), "equal tags": ("tags", '["ab","ab"]', "$.tags:uniqueItems"),
    "short tag": ("tags", '["ab","c"]', "$.tags:items"), "size fits twice": ("size", "15", "$.size:oneOf"), "note": ("note", '"x"', "$.note:type"), "more": ("more", "1", "$:additionalProperties"), "open": ("open", '"yes"', "$.open:type"),
}
FIELDS_JSON = {"id": "concat('\"o', CAST(o_orderkey AS STRING), '\"')", "kind": "concat('\"', o_orderstatus, '\"')", "version": "'2'", "at": "'\"2024-05-01T10:00:00Z\"'", "url": "'\"https://h.example/a\"'", "tags": "'[\"ab\",\"cd\"]'", "size": "'30'", "open": "'true'"}
NTH = f"o_orderkey % {len(DEFECTS)}"


def field_json(name: str) -> str:
    """A field of a document, with its defect where the document's number says so; null leaves it out."""
    cases = " ".join(f"WHEN {n} THEN {'NULL' if v is None else repr(v)}" for n, (field, v, _) in enumerate(DEFECTS.values()) if field == name)
    value = FIELDS_JSON.get(name, "NULL")
    return f"CASE {NTH} {cases} ELSE {value} END" if cases else value


@query(f"SELECT o_orderkey, x.rule FROM orders JOIN (VALUES {', '.join(f'({n}, {r!r})' for n, (_, _, r) in enumerate(DEFECTS.values()) if r)}) AS x(n, rule) ON x.n = {NTH}")
def schema_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that JSON documents break, one document for each order."""
    made = F.concat(F.lit("{"), F.concat_ws(",", *(F.concat(F.lit(f'"{f}":'), F.expr(field_json(f))) for f in (*FIELDS_JSON, "note", "more"))), F.lit("}"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.parse_json(made).alias("doc"))
    return validate.violations(rows, "o_orderkey", validate.schema_rules(WHOLE_SCHEMA, F.col("doc")))


@query("SELECT o_orderkey, o_custkey FROM orders ANTI JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 3) ON o_custkey = c_custkey")
def foreign_key_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers outside a subset of nine tenths of them."""
    parents = table(spark, sf_dir, "customer").where("c_custkey % 10 <> 3")
    return validate.orphans(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), parents, "o_custkey", "c_custkey")


#: A brand needs the types of its parts, a type their sizes by remainder, and the size of two the first brand, which closes a cycle.
NEEDS_SQL = """e AS (SELECT DISTINCT p_brand AS node, p_type AS needs FROM part UNION SELECT p_type, 'size ' || p_size % 3 FROM part UNION SELECT 'size 2', min(p_brand) FROM part)"""


@query(f"WITH RECURSIVE {NEEDS_SQL}, r(node, needs) AS (SELECT node, needs FROM e UNION SELECT r.node, e.needs FROM r JOIN e ON e.node = r.needs) SELECT node, needs, node = needs AS cyclic FROM r")
def dag_reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What brands, types and sizes of parts need, directly or not; a node that needs itself lies on a cycle."""
    part = table(spark, sf_dir, "part")
    pairs = part.select(F.col("p_brand").alias("node"), F.col("p_type").alias("needs")).unionAll(part.select("p_type", F.concat(F.lit("size "), (F.col("p_size") % 3).cast("string"))))
    first = part.agg(F.min("p_brand").alias("needs")).select(F.lit("size 2").alias("node"), "needs").where("needs IS NOT NULL")
    return validate.reachable(pairs.unionAll(first)).withColumn("cyclic", F.col("node") == F.col("needs"))


@query("WITH p AS (SELECT label, CAST(embedding[1] AS DOUBLE) * 500 AS x, CAST(embedding[2] AS DOUBLE) * 250 AS y FROM embeddings) SELECT label, count(*) AS n, min(x) AS west, min(y) AS south, max(x) AS east, max(y) AS north FROM p WHERE abs(x) <= 180 AND abs(y) <= 90 GROUP BY label")
def bbox_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extents of points made of the first two components; points off the globe don't count."""
    rows = table(spark, sf_dir, "embeddings").select("label", F.array(F.struct((F.col("embedding")[0].cast("double") * 500).alias("x"), (F.col("embedding")[1].cast("double") * 250).alias("y"))).alias("p"))
    box = rows.select("label", extent(F.col("p")).alias("b")).where("b IS NOT NULL")
    return box.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("b.west").alias("west"), F.min("b.south").alias("south"), F.max("b.east").alias("east"), F.max("b.north").alias("north"))


@query(f"WITH {sql.records()} SELECT source_surface, CASE WHEN source_surface IN ('documents', 'pages') THEN 'available' ELSE 'planned' END AS binding, count(*) AS n FROM r GROUP BY ALL")
def binding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("source_surface").isin("documents", "pages"), "available").otherwise("planned")
    return records(spark, sf_dir).groupBy("source_surface", status.alias("binding")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {sql.records()} SELECT count(*) AS records, count(DISTINCT source_surface) AS sources, count(DISTINCT publisher_title) AS publishers, count(*) FILTER (notes IS NOT NULL) AS described, {len(LANES)} AS lanes FROM r")
def snapshot_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("source_surface").alias("sources"), F.countDistinct("publisher_title").alias("publishers"), F.count("notes").alias("described"), F.lit(len(LANES)).alias("lanes")
    )
