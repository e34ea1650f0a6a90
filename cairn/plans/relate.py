"""Queries over relationships and identities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.functions.text import similarity_tokens
from cairn.operators import index, relate
from cairn.operators.identity import alias_resolution as resolve_aliases
from cairn.operators.identity import compare, identities, lookup
from cairn.operators.ledger import set_digest
from cairn.plans import sql
from cairn.plans.registry import query
from cairn.plans.search import FIELDS_SQL
from cairn.scratch import materialize
from cairn.sources.records import corpus, records, table

LANES = tuple(sql.LANES)
CONTEXT = "compare selecting almond the Supplier published"
CONTEXT_TERMS = index.query_tokens(CONTEXT)


def similar_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir)


PAIRS_SQL = f"""WITH {sql.records()}, t AS (SELECT id, title, source_surface, list_distinct({sql.similarity("coalesce(title, '')")}) AS tt, list_distinct({sql.similarity("concat_ws(' ', title, array_to_string(topics, ' '), array_to_string(tags, ' '))")}) AS ta FROM r),
e AS (SELECT id, unnest(ta) AS token FROM t),
p AS (SELECT DISTINCT a.id AS id, b.id AS other FROM e a JOIN e b USING (token) WHERE a.id <> b.id),
s AS (SELECT p.id, p.other, y.title AS title, x.ta AS a1, y.ta AS a2, x.source_surface AS s1, y.source_surface AS s2,
 CAST(0.75 AS DOUBLE) * CASE WHEN len(x.tt) + len(y.tt) > 0 THEN len(list_intersect(x.tt, y.tt)) / (len(x.tt) + len(y.tt) - len(list_intersect(x.tt, y.tt))) ELSE 0 END
 + CAST(0.25 AS DOUBLE) * CASE WHEN len(x.ta) + len(y.ta) > 0 THEN len(list_intersect(x.ta, y.ta)) / (len(x.ta) + len(y.ta) - len(list_intersect(x.ta, y.ta))) ELSE 0 END AS score FROM p JOIN t x ON x.id = p.id JOIN t y ON y.id = p.other),
q AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, title, other) AS INTEGER) AS rank FROM s WHERE score >= CAST(0.32 AS DOUBLE))"""


@query(PAIRS_SQL + " SELECT id, other, rank, round(score, 3) AS similarity, array_to_string(list_sort(list_intersect(a1, a2))[1:12], ',') AS shared, CASE WHEN s1 = s2 THEN 'alternative' ELSE 'cross-source-alternative' END AS kind FROM q WHERE rank <= 4")
def alternatives_top4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.alternatives(similar_records(spark, sf_dir)).withColumn("shared", F.array_join("shared", ","))


#: What records of the lanes lack, from what they have: expressions of Spark and of SQL alike.
MORE = {
    "dataset_family": "split_part(measure, ' ', 1)", "subtopic": "CASE WHEN record_type = 'Document' THEN concat('in ', publisher_title) END", "geography_vintage": "CASE WHEN record_type = 'Supplier' THEN 2011 + length(title) % 10 END",
    "time_coverage": "CASE WHEN record_type = 'Page' THEN concat('200', length(title) % 10) END", "latest_edition": "CASE WHEN record_type = 'Part' THEN substring(unit_of_measure, 1, 1) END",
    "latest_version": "CASE WHEN record_type = 'Part' THEN substring(unit_of_measure, 2, 1) END", "methodology_count": "length(title) % 2", "quality_count": "length(title) % 3",
}
CONTRAST_SQL = {
    "source surface": "source_surface", "record type": "record_type", "dataset family": "dataset_family", "topic": "coalesce(nullif(subtopic, ''), array_to_string(topics, ','))", "measure": "measure", "unit": "unit_of_measure", "frequency": "NULL",
    "population": "population_type", "geography": "array_to_string(area_served, ',')", "geography vintage": "geography_vintage::VARCHAR", "time coverage": "time_coverage", "source producers": "publisher_title", "edition": "latest_edition",
    "version": "latest_version", "release state": "state", "last updated": "NULL", "methodology evidence": "(methodology_count > 0)::VARCHAR", "quality documentation": "(quality_count > 0)::VARCHAR",
}
MORE_SQL = "m AS (SELECT *, " + ", ".join(f"{v} AS {k}" for k, v in MORE.items()) + " FROM r)"


@query(
    PAIRS_SQL + f", {MORE_SQL}, v AS (SELECT id, [" + ", ".join(f"coalesce({v}, '')" for v in CONTRAST_SQL.values()) + f"""] AS own FROM m),
    d AS (SELECT q.id, q.other, ({list(CONTRAST_SQL)})[i] AS field, v.own[i] AS selected, w.own[i] AS alternative FROM (SELECT id, other, unnest(range(1, {len(CONTRAST_SQL) + 1})) AS i FROM q WHERE rank <= 4) q JOIN v ON v.id = q.id JOIN v w ON w.id = q.other)
    SELECT * FROM d WHERE selected <> alternative"""
)
def contrast_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields in which records differ from their alternatives."""
    own = similar_records(spark, sf_dir)
    more = own.select("*", *(F.expr(v).alias(k) for k, v in MORE.items()))
    link = lambda n: F.when(F.col(n) > 0, F.array(F.lit("https://m.example/"))).otherwise(F.array().cast("array<string>"))
    return relate.contrasts(relate.alternatives(own), more.withColumns({"methodology_links": link("methodology_count"), "quality_links": link("quality_count")}))


@query(PAIRS_SQL + " SELECT r.id, coalesce('Compare before selecting: ' || n.t || '.', 'No close alternative was identified from available metadata.') AS context_note FROM r LEFT JOIN (SELECT id, string_agg(title, '; ' ORDER BY rank) AS t FROM q WHERE rank <= 3 GROUP BY id) n ON n.id = r.id")
def context_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = similar_records(spark, sf_dir)
    return relate.context_notes(relate.alternatives(own), own)


CONTEXT_FIELDS = FIELDS_SQL | {"context": "note"}


@query(
    PAIRS_SQL + ", o AS (SELECT r.* EXCLUDE (title), r.title, coalesce('Compare before selecting: ' || n.t || '.', 'No close alternative was identified from available metadata.') AS note FROM r LEFT JOIN (SELECT id, string_agg(title, '; ' ORDER BY rank) AS t FROM q WHERE rank <= 3 GROUP BY id) n ON n.id = r.id), f AS ("
    + " UNION ALL ".join(f"SELECT id, {index.WEIGHTS[f]} AS w, unnest({sql.tokens(f'coalesce({x}, {chr(39) * 2})')}) AS token FROM o" for f, x in CONTEXT_FIELDS.items())
    + f"), z AS (SELECT id, count(DISTINCT token) AS matched, sum(w) AS score FROM f WHERE list_contains({sql.quoted(tuple(CONTEXT_TERMS))}, token) GROUP BY id) SELECT id, title, CAST(matched AS INTEGER) AS matched, CAST(score AS INTEGER) AS score FROM z JOIN r USING (id) ORDER BY matched DESC, score DESC, lower(title), id LIMIT 20"
)
def search_with_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked search in which the titles of a record's alternatives are its context."""
    own = similar_records(spark, sf_dir)
    notes = relate.context_notes(relate.alternatives(own), own)
    return index.ranked(own.drop("context_note").join(notes, "id"), CONTEXT, 20).select("id", "title", "matched", "score")


@query(PAIRS_SQL + ", h AS (SELECT DISTINCT id FROM q WHERE rank <= 4) SELECT source_surface, CASE WHEN h.id IS NULL THEN 'no' ELSE 'yes' END AS has_alternatives, count(*) AS n FROM r LEFT JOIN h USING (id) GROUP BY ALL")
def alternative_facet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records of each source have alternatives."""
    own = similar_records(spark, sf_dir).select("id", "source_surface", "title", "topics", "tags")
    having = relate.alternatives(own).select("id").distinct().withColumn("has", F.lit(True))
    return own.join(having, "id", "left").groupBy("source_surface", F.when(F.col("has"), "yes").otherwise("no").alias("has_alternatives")).agg(F.count(F.lit(1)).alias("n"))


CODES_SQL = f"""WITH {sql.records("parts")}, o AS (SELECT declared_code AS code, id, title, measure = 'ECONOMY' AS anchor, trim(regexp_replace(replace(lower(title), '&', 'and'), '[^a-z0-9]+', ' ', 'g')) AS words FROM r),
a AS (SELECT code, count(*) AS anchors, min(id) AS anchor_id, arg_min(words, id) AS wanted FROM o WHERE anchor GROUP BY code),
b AS (SELECT o.code, count(*) AS candidates, count(*) FILTER (words = wanted) AS titled, min(o.id) AS any_id, min(o.id) FILTER (words = wanted) AS match_id FROM o JOIN a USING (code) WHERE NOT anchor GROUP BY o.code),
s AS (SELECT a.code, CASE WHEN anchors > 1 THEN 'ambiguous-anchor-source' WHEN candidates IS NULL THEN 'unmatched' WHEN titled = 1 THEN 'normalised-identical' WHEN candidates = 1 THEN 'conflicted' ELSE 'ambiguous-cross-source-candidates' END AS status, anchors, anchor_id, coalesce(candidates, 0) AS candidates, titled, any_id, match_id FROM a LEFT JOIN b USING (code))"""


@query(CODES_SQL + " SELECT code, status, CASE WHEN anchors = 1 THEN anchor_id END AS anchor_id, CASE WHEN status IN ('normalised-identical', 'conflicted') THEN CASE WHEN titled = 1 THEN match_id ELSE any_id END END AS candidate_id, anchors, candidates FROM s")
def reconcile_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.reconcile(records(spark, sf_dir, "parts"), F.col("measure") == "ECONOMY")


@query(CODES_SQL + " SELECT status, count(*) AS codes, CAST(sum(candidates) AS BIGINT) AS candidates FROM s GROUP BY status")
def reconcile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile_codes(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("codes"), F.sum("candidates").alias("candidates"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternatives of documents and representations of parts."""
    near = relate.alternatives(similar_records(spark, sf_dir)).select(F.col("id").alias("source"), F.col("other").alias("target"), "kind")
    codes = reconcile_codes(spark, sf_dir).where("candidate_id IS NOT NULL")
    return near.unionByName(codes.select(F.col("anchor_id").alias("source"), F.col("candidate_id").alias("target"), F.lit("cross-source-representation").alias("kind")))


TRIPLES_SQL = (
    PAIRS_SQL + ", " + CODES_SQL.split("SELECT * FROM r", 1)[0].replace("WITH r AS", "rp AS", 1).replace(" FROM r)", " FROM rp)", 1).replace("s AS (SELECT a.code", "sc AS (SELECT a.code")
    + """, k AS (SELECT * FROM (VALUES """ + ", ".join(f"('{k}', '{p}', '{s}', '{r}')" for k, (p, s, r) in relate.KINDS.items()) + """) AS x(kind, predicate, status, rule)),
    g AS (SELECT id AS source, other AS target, CASE WHEN s1 = s2 THEN 'alternative' ELSE 'cross-source-alternative' END AS kind FROM q WHERE rank <= 4
     UNION ALL SELECT anchor_id, CASE WHEN titled = 1 THEN match_id ELSE any_id END, 'cross-source-representation' FROM sc WHERE status IN ('normalised-identical', 'conflicted')),
    tr AS (SELECT 'record/' || source AS subject, predicate, 'record/' || target AS object, status, rule, sha256('record/' || source || '|' || predicate || '|record/' || target) AS assertion_id FROM g JOIN k USING (kind))"""
)


@query(TRIPLES_SQL + " SELECT * FROM tr")
def relationship_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.triples(edges(spark, sf_dir))


@query(TRIPLES_SQL + f", hashed AS (SELECT predicate, sha256(assertion_id) AS h FROM tr), {sql.set_digest('predicate', 'hashed')} SELECT predicate, n, digest FROM digests")
def triple_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of the set of assertions of each predicate."""
    return set_digest(relate.triples(edges(spark, sf_dir)), "predicate", F.col("assertion_id"))


@query(TRIPLES_SQL + " SELECT CASE WHEN assertion_id < '1' THEN 'not in direct' ELSE 'twice in reified' END AS kind, count(*) AS disagreeing FROM tr WHERE assertion_id < '2' GROUP BY 1")
def projection_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runtime, reified and direct triples must be the same set, each once: counts what disagrees.

    Assertions whose id begins with 0 were left out of the direct triples, and those with 1 reified twice.
    """
    runtime = materialize(relate.triples(edges(spark, sf_dir)), "triples")
    direct = relate.grouped_targets(runtime.where("assertion_id >= '1'")).select("subject", "predicate", F.explode("objects").alias("object"))
    reified = runtime.groupBy("assertion_id").agg(F.min(F.struct("subject", "predicate", "object")).alias("t")).select("t.*", "assertion_id")
    reified = reified.unionAll(reified.where("assertion_id >= '1' AND assertion_id < '2'"))
    kind = F.when(F.col("in_2") == 0, "not in direct").when(F.col("in_1") > 1, "twice in reified").otherwise("other")
    return relate.disagreement(runtime, reified, direct).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("disagreeing"))


GENERATED = "2026-01-01T00:00:00Z"
#: Provenance of a record by its number modulo four: all fields, the second, the third, none.
SEEN_SQL = """CASE CAST(native_id AS BIGINT) % 4 WHEN 0 THEN '2025-01-01' WHEN 1 THEN '2025-02-02' WHEN 2 THEN '2025-03-03' ELSE '2026-01-01T00:00:00Z' END"""
BASIS_SQL = f"CASE CAST(native_id AS BIGINT) % 4 WHEN 0 THEN 'provenance.retrieved_at' WHEN 1 THEN 'provenance.source_commit_as_of' WHEN 2 THEN 'provenance.source_as_of' ELSE '{relate.NOT_SEEN}' END"


def evidenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("native_id").cast("long") % 4
    fields = {"retrieved_at": F.when(number == 0, "2025-01-01"), "source_commit_as_of": F.when(number < 2, "2025-02-02"), "source_as_of": F.when(number < 3, " 2025-03-03 "), "source_url": F.col("url")}
    return similar_records(spark, sf_dir).withColumn("provenance", F.create_map(*(x for k, v in fields.items() for x in (F.lit(k), v))))


def scored_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alternatives with their scores; every fifth record is joined to one that isn't there, and every seventh has a score over 1."""
    near = relate.alternatives(similar_records(spark, sf_dir)).select(F.col("id").alias("source"), F.col("other").alias("target"), "kind", "similarity", "rank")
    number = F.split_part("source", F.lit(":"), F.lit(2)).cast("long")
    target = F.when((number % 5 == 0) & (F.col("rank") == 1), "documents:none").otherwise(F.col("target"))
    return near.select("source", target.alias("target"), "kind", (F.col("similarity") + F.when(number % 7 == 0, 1).otherwise(0)).alias("score"))


EDGES_SQL = PAIRS_SQL + f""", n AS (SELECT id AS source, CASE WHEN CAST(split_part(id, ':', 2) AS BIGINT) % 5 = 0 AND rank = 1 THEN 'documents:none' ELSE other END AS target, CASE WHEN s1 = s2 THEN 'alternative' ELSE 'cross-source-alternative' END AS kind,
 round(score, 3) + CASE WHEN CAST(split_part(id, ':', 2) AS BIGINT) % 7 = 0 THEN 1 ELSE 0 END AS score FROM q WHERE rank <= 4),
k AS (SELECT * FROM (VALUES """ + ", ".join(f"('{k}', '{p}', '{s}', '{r}')" for k, (p, s, r) in relate.KINDS.items()) + f""") AS x(kind, predicate, status, rule)),
w AS (SELECT id, {SEEN_SQL} AS seen, {BASIS_SQL} AS basis, coalesce(nullif(url, ''), 'data/governance/release.json') AS url, coalesce(license_id, 'not-evaluated') AS license_id FROM r)"""


@query(
    EDGES_SQL + """ SELECT sha256('record/' || source || '|' || predicate || '|record/' || target) AS assertion_id, source, predicate, target, status, rule, n.score AS confidence, true AS discovery_only, a.seen AS source_retrieved_at, a.basis AS source_basis, a.url AS source_url,
    a.license_id AS source_license_id, b.seen AS target_retrieved_at, b.basis AS target_basis, b.url AS target_url, b.license_id AS target_license_id FROM n JOIN k USING (kind) JOIN w a ON a.id = n.source JOIN w b ON b.id = n.target"""
)
def compiled_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assertions with the evidence and rights of both endpoints."""
    rows = relate.compiled(scored_edges(spark, sf_dir), evidenced(spark, sf_dir), GENERATED)
    return rows.drop("source_locator", "target_locator", "source_value", "target_value")


@query(EDGES_SQL + " SELECT source, target, 'unregistered' AS fault FROM n WHERE target NOT IN (SELECT id FROM r) UNION SELECT source, target, 'score' FROM n WHERE score > 1")
def relationship_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges that can't be compiled: an endpoint is missing, or the score is out of range."""
    own = materialize(scored_edges(spark, sf_dir), "edges")
    lost = relate.unregistered(own, similar_records(spark, sf_dir)).select("source", "target", F.lit("unregistered").alias("fault"))
    return lost.unionAll(relate.out_of_range(own).select("source", "target", F.lit("score").alias("fault")))


IDENTITY_SQL = f"""WITH {sql.records()}, i AS (SELECT lower(id) AS key, id, 1 AS priority FROM r UNION SELECT lower(native_id), id, 2 FROM r UNION SELECT lower(title), id, 3 FROM r),
best AS (SELECT key, min(priority) AS p FROM i GROUP BY key), m AS (SELECT key, priority, count(DISTINCT id) AS matches, min(id) AS first_id FROM i JOIN best USING (key) WHERE priority = p GROUP BY key, priority)"""


@query(IDENTITY_SQL + ", w AS (SELECT unnest(['parts:7', 'PARTS:7', '7', 'Supplier#000000003', 'nothing', 'customers:12']) AS wanted) SELECT wanted, CASE WHEN matches IS NULL THEN 'NOT_FOUND' WHEN matches > 1 THEN 'AMBIGUOUS' ELSE 'FOUND' END AS outcome, CASE WHEN matches = 1 THEN first_id END AS id FROM w LEFT JOIN m ON m.key = lower(wanted)")
def identity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = spark.createDataFrame([(x,) for x in ("parts:7", "PARTS:7", "7", "Supplier#000000003", "nothing", "customers:12")], "wanted string")
    return lookup(identities(records(spark, sf_dir)), wanted)


@query(IDENTITY_SQL + " SELECT key, priority, matches, first_id FROM m WHERE matches > 1")
def identity_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identities(records(spark, sf_dir)).where("matches > 1")


@query(f"WITH {sql.records('suppliers')}, a AS (SELECT 'alias-' || s_suppkey AS alias, 'suppliers:' || (s_suppkey * 2) AS target FROM supplier) SELECT alias, target, r.id IS NOT NULL AS resolved, r.title FROM a LEFT JOIN r ON r.id = a.target")
def alias_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = table(spark, sf_dir, "supplier").select(F.concat(F.lit("alias-"), F.col("s_suppkey").cast("string")).alias("alias"), F.concat(F.lit("suppliers:"), (F.col("s_suppkey") * 2).cast("string")).alias("target"))
    return resolve_aliases(aliases, records(spark, sf_dir, "suppliers"))


COMPARED = ("parts:1", "parts:2", "suppliers:1")
COMPARE_SQL = {"native_id": "native_id", "source_surface": "source_surface", "record_type": "record_type", "measure": "measure", "unit_of_measure": "unit_of_measure", "population_type": "population_type",
    "publisher_title": "publisher_title", "state": "state", "topics": "array_to_string(topics, ',')", "area_served": "array_to_string(area_served, ',')"}


@query(
    f"WITH {sql.records(*LANES)}, v AS (" + " UNION ALL ".join(f"SELECT id, '{k}' AS field, nullif({v}, '') AS value FROM r WHERE id IN {COMPARED}" for k, v in COMPARE_SQL.items())
    + ") SELECT field, count(DISTINCT coalesce(value, chr(1))) > 1 AS different, string_agg(id || '=' || coalesce(value, ''), ';' ORDER BY id) AS \"values\" FROM v GROUP BY field"
)
def compare_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare(records(spark, sf_dir, *LANES), COMPARED, list(COMPARE_SQL))


DEMO_TERMS = ("idiot", "license", "the", "password")
DEMO_SQL = f"""WITH {sql.corpus()}, n AS (SELECT *, row_number() OVER (PARTITION BY source_surface ORDER BY ordinal) AS nth FROM c),
t AS (SELECT n.ordinal, k.term, k.k, row_number() OVER (PARTITION BY source_surface, k.term ORDER BY ordinal) AS nth FROM n JOIN (VALUES {", ".join(f"('{t}', {i})" for i, t in enumerate(DEMO_TERMS))}) AS k(term, k) ON contains(lower(title || ' ' || coalesce(notes, '')), term) WHERE source_surface <> 'suppliers'),
p AS (SELECT ordinal, 0 AS priority FROM n WHERE source_surface = 'suppliers' UNION ALL SELECT ordinal, 1 FROM n WHERE source_surface <> 'suppliers' AND nth <= 50 UNION ALL SELECT ordinal, 2 + k FROM t WHERE nth <= 30)
SELECT id, priority FROM (SELECT ordinal, min(priority) AS priority FROM p GROUP BY ordinal) JOIN c USING (ordinal) ORDER BY priority, ordinal LIMIT 1200"""


@query(DEMO_SQL)
def demo_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded selection: one lane whole, the first fifty of each other, thirty for each term; first reason wins, at most 1,200."""
    own = corpus(spark, sf_dir)
    text = F.lower(F.concat_ws(" ", "title", F.coalesce("notes", F.lit(""))))
    hits = F.filter(F.array(*(F.struct(F.lit(i).alias("k"), F.lit(t).alias("term")) for i, t in enumerate(DEMO_TERMS))), lambda x: text.contains(x["term"]))
    rows = own.select("id", "ordinal", "source_surface", hits.alias("hits"))
    first = Window.partitionBy("source_surface").orderBy("ordinal")
    lane = rows.where("source_surface = 'suppliers'").select("id", "ordinal", F.lit(0).alias("priority"))
    others = rows.where("source_surface <> 'suppliers'")
    sample = others.withColumn("nth", F.row_number().over(first)).where("nth <= 50").select("id", "ordinal", F.lit(1).alias("priority"))
    each = others.select("id", "ordinal", "source_surface", F.explode("hits.k").alias("k"))
    termed = each.withColumn("nth", F.row_number().over(Window.partitionBy("source_surface", "k").orderBy("ordinal"))).where("nth <= 30")
    chosen = lane.unionAll(sample).unionAll(termed.select("id", "ordinal", (F.col("k") + 2).alias("priority")))
    return chosen.groupBy("id", "ordinal").agg(F.min("priority").alias("priority")).orderBy("priority", "ordinal").limit(1200).select("id", "priority")


@query(f"WITH {sql.records('documents')} SELECT id, len({sql.similarity('title')}) AS n_tokens, len(list_distinct({sql.similarity('title')})) AS n_distinct FROM r")
def similarity_tokens_of_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = similarity_tokens(F.col("title"))
    return records(spark, sf_dir, "documents").select("id", F.size(words).cast("long").alias("n_tokens"), F.size(F.array_distinct(words)).cast("long").alias("n_distinct"))
