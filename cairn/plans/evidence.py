"""Queries over evidence in titles and descriptions, presence rules and lists. The texts are made of table rows by expressions that both engines take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions import evidence as e
from cairn.functions.text import SECRET_KEYS, canonical_standard
from cairn.functions.values import GAP_WORDS, distinct_folded, has_value, is_gap, text_list
from cairn.plans import sql
from cairn.plans.registry import query
from cairn.sources.records import records, table


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


YEAR = "CAST(1990 + o_orderkey % 40 AS STRING)"
NEXT = "CAST(1991 + o_orderkey % 40 AS STRING)"
TITLE = (
    f"concat('Wards ', {YEAR}, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN concat(' to ', {NEXT}) WHEN 2 THEN concat(' (v', CAST(o_orderkey % 9 AS STRING), '.', CAST(o_orderkey % 3 AS STRING), ')')"
    f" WHEN 3 THEN concat(' and ', {YEAR}) ELSE concat(' code 1', {YEAR}) END)"
)
CADENCE = "CASE o_orderkey % 7 WHEN 0 THEN 'Updated annually, once quarterly.' WHEN 1 THEN 'Issued every 12 weeks, or every 6 weeks.' WHEN 2 THEN 'Annually' WHEN 3 THEN 'annual figures' WHEN 4 THEN 'QUARTERLY' WHEN 5 THEN 'issued every 12 weeks' ELSE o_orderpriority END"
YEARS_SQL = "list_distinct(list_filter(regexp_extract_all(title, '\\d+'), lambda x: length(x) = 4 AND left(x, 2) IN ('18', '19', '20')))"
TITLE_YEAR_SQL = f"CASE WHEN len({YEARS_SQL}) = 1 THEN CAST({YEARS_SQL}[1] AS INTEGER) END"
CADENCE_SQL = "CASE " + " ".join(f"WHEN regexp_matches(body, {quoted(p)}) THEN {quoted(k)}" for k, p in e.CADENCES.items()) + " END"


@query(f"SELECT o_orderkey, {TITLE_YEAR_SQL} AS year, nullif(upper(regexp_extract(title, '(?i)\\((V\\d+(?:\\.\\d+)?)\\)', 1)), '') AS version, {CADENCE_SQL} AS cadence FROM (SELECT o_orderkey, {TITLE} AS title, {CADENCE} AS body FROM orders)")
def title_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year, version and cadence that titles and descriptions state."""
    own = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(TITLE).alias("title"), F.expr(CADENCE).alias("body"))
    return own.select("o_orderkey", e.title_year(F.col("title")).alias("year"), e.version_label(F.col("title")).alias("version"), e.cadence(F.col("body")).alias("cadence"))


STANDS = f"CASE o_orderkey % 4 WHEN 0 THEN concat('Boundaries as at 31 December ', {YEAR}, '.') WHEN 1 THEN concat('As at ', {NEXT}, ' only.') WHEN 2 THEN concat('as at 1st May ', {YEAR}, ' and as at June ', {YEAR}) ELSE concat(repeat('x', 301), ' as at May ', {YEAR}) END"


@query(
    f"""SELECT o_orderkey, CASE WHEN len(regexp_extract_all(body, {quoted(e.AS_AT)}, 1)) = 1 AND strpos(body, regexp_extract(body, {quoted(e.AS_AT)}, 0)) BETWEEN 1 AND 301
    AND CAST(nullif(regexp_extract(body, {quoted(e.AS_AT)}, 2), '') AS INTEGER) = {TITLE_YEAR_SQL} THEN regexp_extract(body, {quoted(e.AS_AT)}, 1) END AS stands_at FROM (SELECT o_orderkey, {TITLE} AS title, {STANDS} AS body FROM orders)"""
)
def reference_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one date that a description says it stands at, where its year is the title's."""
    return table(spark, sf_dir, "orders").select("o_orderkey", e.reference_date(F.expr(TITLE), F.expr(STANDS)).alias("stands_at"))


NOTED = "concat(text, CASE doc_id % 3 WHEN 0 THEN concat('. See data quality and limitations of ', source, ' first. ') WHEN 1 THEN ' Known limitations/caveats: ' ELSE '' END, text)"


def excerpt_sql(t: str, phrase: str) -> str:
    match = f"regexp_extract({t}, {quoted(phrase)}, 0)"
    parts = f"SELECT doc_id, {t} AS t, {match} AS m, strpos({t}, {match}) AS p FROM (SELECT doc_id, {NOTED} AS body FROM documents) WHERE regexp_matches({t}, {quoted(phrase)})"
    cut = f"SELECT doc_id, m, left(t, p - 1) AS before, substr(t, p + length(m)) AS after FROM ({parts})"
    whole = f"SELECT doc_id, m, before, after, string_split(before, '. ')[-1] || m || CASE WHEN strpos(after, '. ') > 0 THEN left(after, strpos(after, '. ')) ELSE after END AS s FROM ({cut})"
    return f"SELECT doc_id, sha256(trim(CASE WHEN length(s) > 500 THEN right(before, 180) || m || left(after, 300) ELSE s END)) AS note_sha256 FROM ({whole})"


@query(f"SELECT d.doc_id, n.note_sha256 FROM documents d LEFT JOIN ({excerpt_sql('body', e.QUALITY_NOTE)}) n USING (doc_id)")
def quality_excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of the sentence around a phrase that points to quality notes, planted between two copies of each text."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(e.quality_note(F.expr(NOTED)), 256).alias("note_sha256"))


LINKED = (
    "concat(CASE page_id % 3 WHEN 0 THEN 'Methodology: ' WHEN 1 THEN 'Home page: ' ELSE concat('methodological notes ', repeat('x', 190)) END, split_part(url, '#', 1), '#a', CAST(page_id AS STRING), '. Methods at https://m.example/',"
    " CAST(page_id AS STRING), ', methodology (http://n.example/q?key=', CAST(page_id AS STRING), ') [Quality report](https://q.example/', CAST(page_id AS STRING), ') and [home](https://h.example/qmi) [QMI](https://i.example/x)')"
)
SECRET_SQL = f"regexp_matches(lower(regexp_replace(u, '#.*$', '')), '[?&]({'|'.join(SECRET_KEYS)})(=|&|$)')"


@query(
    f"""WITH t AS (SELECT page_id, {LINKED} AS t FROM pages), l AS (SELECT page_id, t, unnest(regexp_extract_all(t, {quoted(e.URL)}, 0)) AS raw FROM t),
    k AS (SELECT page_id, rtrim(raw, '.,;:!?') AS u FROM l WHERE regexp_matches(right(left(t, strpos(t, raw) - 1), 180), {quoted(e.METHOD_WORD)})),
    m AS (SELECT DISTINCT page_id, u FROM k WHERE regexp_matches(u, '^https?://[^/@?#]+(?:[/?#]|$)') AND NOT {SECRET_SQL}),
    q AS (SELECT DISTINCT page_id, p[2] AS u FROM (SELECT page_id, unnest(list_zip(regexp_extract_all(t, '(?i)\\[([^\\]]+)\\]\\((https?://[^)\\s]+)\\)', 1), regexp_extract_all(t, '(?i)\\[([^\\]]+)\\]\\((https?://[^)\\s]+)\\)', 2))) AS p FROM t) WHERE regexp_matches(p[1] || ' ' || p[2], {quoted(e.QUALITY_LINK)}))
    SELECT page_id, coalesce((SELECT string_agg(u, ' ' ORDER BY u) FROM m WHERE m.page_id = t.page_id), '') AS methodology, coalesce((SELECT string_agg(u, ' ' ORDER BY u) FROM q WHERE q.page_id = t.page_id), '') AS quality FROM t"""
)
def evidence_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Public links with a word for methods shortly before them, and Markdown links about quality."""
    own = table(spark, sf_dir, "pages").select("page_id", F.expr(LINKED).alias("t"))
    return own.select("page_id", F.array_join(e.labelled_links(F.col("t")), " ").alias("methodology"), F.array_join(e.markdown_links(F.col("t"), e.QUALITY_LINK), " ").alias("quality"))


KEYWORDS = "concat_ws(';', CASE c_custkey % 4 WHEN 0 THEN 'UK' WHEN 1 THEN ' england and wales' WHEN 2 THEN 'Wa' ELSE 'mars' END, CASE c_custkey % 3 WHEN 0 THEN 'uk ' WHEN 1 THEN 'SC' ELSE lower(c_mktsegment) END)"
CODES = "concat_ws(';', CASE c_custkey % 5 WHEN 0 THEN 'e' WHEN 1 THEN 'N' WHEN 2 THEN 's ' ELSE 'x' END, CASE c_custkey % 2 WHEN 0 THEN 'W' ELSE 'E' END)"
CATEGORIES = "concat_ws(';', '/Categories/Latest/', CASE c_custkey % 3 WHEN 0 THEN '/Categories/Wards' WHEN 1 THEN '/categories/ONS Geography Open Data' ELSE '/Categories/Names/Old' END, '/Categories/Wards')"


def listed_sql(values: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list_filter({values}, lambda x: x IS NOT NULL))), ',')"


def named_sql(x: str, names: dict[str, str]) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in names.items()) + " END"


@query(
    f"""SELECT c_custkey, {listed_sql(f"list_transform(string_split({KEYWORDS}, ';'), lambda x: {named_sql('lower(trim(x))', e.AREAS)})")} AS areas,
    {listed_sql(f"list_transform(string_split({CODES}, ';'), lambda x: {named_sql('upper(trim(x))', e.COUNTRIES)})")} AS countries,
    {listed_sql(f"list_transform(list_filter(string_split({CATEGORIES}, ';'), lambda x: rtrim(lower(x), '/') NOT IN {e.CONTAINERS}), lambda x: regexp_replace(x, '^/Categories/', ''))")} AS subtopics FROM customer"""
)
def area_and_subtopics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas that keywords and codes name, and subtopics without the categories that hold everything."""
    parted = lambda x: F.split(F.expr(x), ";")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.array_join(e.area_served(parted(KEYWORDS)), ",").alias("areas"), F.array_join(e.countries(parted(CODES)), ",").alias("countries"),
        F.array_join(e.subtopics(e.informative(parted(CATEGORIES))), ",").alias("subtopics"),
    )


TWO = "lpad(CAST({} AS STRING), 2, '0')".format
EXPIRY = (
    f"concat('2026-', {TWO('1 + event_id % 12')}, '-', {TWO('1 + event_id % 28')}, 'T', {TWO('event_id % 24')}, ':', {TWO('event_id % 60')}, ':07',"
    f" CASE event_id % 4 WHEN 0 THEN 'Z' WHEN 1 THEN concat('+', {TWO('event_id % 13')}, ':30') WHEN 2 THEN concat('-', {TWO('event_id % 11')}, ':00') ELSE '' END)"
)


@query(f"SELECT event_id, CASE WHEN event_id % 4 < 3 THEN strftime(CAST({EXPIRY} AS TIMESTAMPTZ) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') END AS expires FROM events")
def expiry_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFC 3339 times in UTC; a quarter lacks an offset and isn't one."""
    return table(spark, sf_dir, "events").select("event_id", e.utc_expiry(F.expr(EXPIRY)).alias("expires"))


PERIODS = f"CASE o_orderkey % 6 WHEN 0 THEN concat_ws(',', {NEXT}, {YEAR}) WHEN 1 THEN concat({YEAR}, '-', {TWO('1 + o_orderkey % 12')}) WHEN 2 THEN concat_ws(',', {YEAR}, {YEAR}) WHEN 3 THEN concat_ws(',', {YEAR}, concat({NEXT}, '-01')) WHEN 4 THEN concat({YEAR}, '-13') ELSE concat_ws(',', concat({YEAR}, '-02'), concat({NEXT}, '-11')) END"
LATEST = "2020-06"


@query(
    f"""WITH p AS (SELECT o_orderkey, string_split({PERIODS}, ',') AS p FROM orders), f AS (SELECT *, len(list_distinct(p)) = len(p) AND (len(list_filter(p, lambda x: regexp_matches(x, '^\\d{{4}}$'))) = len(p) OR len(list_filter(p, lambda x: regexp_matches(x, '^\\d{{4}}-(?:0[1-9]|1[0-2])$'))) = len(p))
    AND len(list_filter(p, lambda x: x > left('{LATEST}', length(x)))) = 0 AS fit FROM p) SELECT o_orderkey, CASE WHEN fit THEN list_min(p) END AS first_period, CASE WHEN fit THEN list_max(p) END AS last_period FROM f"""
)
def period_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last of periods that are all years or all months, each once, none of them in the future."""
    extent = e.period_extent(F.split(F.expr(PERIODS), ","), F.lit(LATEST))
    return table(spark, sf_dir, "orders").select("o_orderkey", extent.alias("x")).select("o_orderkey", F.col("x.start").alias("first_period"), F.col("x.end").alias("last_period"))


REVISED = "concat('Figures for ', source, CASE doc_id % 5 WHEN 0 THEN '. This dataset has been revised after review. ' WHEN 1 THEN '. V2.1 corrects the last table. ' WHEN 2 THEN '. NB: amended by hand. ' WHEN 3 THEN '. Updated 3/5/2021 and later. ' ELSE ' were revised. ' END, text)"


@query(f"SELECT d.doc_id, n.note_sha256 FROM documents d LEFT JOIN ({excerpt_sql('body', e.REVISION_NOTE).replace(NOTED, REVISED)}) n USING (doc_id)")
def revision_excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of the sentence that tells how a resource was revised, planted before each text."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(e.revision_note(F.expr(REVISED)), 256).alias("note_sha256"))


STANDARD = "concat(' ', CASE p_partkey % 4 WHEN 0 THEN 'ISO_639' WHEN 1 THEN 'iso  639' WHEN 2 THEN 'ISO - 639' ELSE p_brand END, CAST(p_partkey % 3 AS STRING), ' ')"
TAGS = "concat_ws(';', p_brand, ' ', lower(p_brand), upper(p_type), p_type, CASE p_partkey % 2 WHEN 0 THEN ' zebra ' ELSE 'Alpha' END, 'alpha')"
TRIMMED_SQL = f"list_filter(list_transform(string_split({TAGS}, ';'), lambda x: trim(x)), lambda x: x <> '')"


@query(
    f"""SELECT p_partkey, regexp_replace(lower(trim({STANDARD})), '[-_\\s]+', '-', 'g') AS standard, array_to_string(list_sort(list_distinct({TRIMMED_SQL})), ',') AS texts,
    array_to_string(list_transform(list_sort(list_transform(list_filter({TRIMMED_SQL}, lambda x, i: list_position(list_transform({TRIMMED_SQL}, lambda y: lower(y)), lower(x)) = i), lambda x: [lower(x), x])), lambda x: x[2]), ',') AS folded FROM part"""
)
def keyword_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical names of standards; sorted distinct texts, by their letters and without regard to case, where the first spelling stays."""
    tags = F.split(F.expr(TAGS), ";")
    return table(spark, sf_dir, "part").select(
        "p_partkey", canonical_standard(F.expr(STANDARD)).alias("standard"), F.array_join(text_list(tags), ",").alias("texts"), F.array_join(distinct_folded(tags), ",").alias("folded")
    )


STATE = "CASE CAST(native_id AS BIGINT) % 5 WHEN 0 THEN ' None ' WHEN 1 THEN 'not-specified' WHEN 2 THEN ' ' ELSE state END"


@query(
    f"""WITH {sql.records()}, s AS (SELECT id, {STATE} AS state, area_served, CAST(nullif(native_id, '7') AS BIGINT) AS number FROM r)
    SELECT id, state IS NULL OR state = '' OR lower(trim(state)) IN {GAP_WORDS} AS state_gap, state IS NOT NULL AND trim(state) <> '' AS state_there, len(area_served) = 0 AS area_gap, len(area_served) > 0 AS area_there, number IS NULL AS number_gap, number IS NOT NULL AS number_there FROM s"""
)
def presence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What displays show as gaps and what evaluations take for values: texts, lists and numbers of all records, words for missing planted in their state."""
    own = records(spark, sf_dir).select("id", F.expr(STATE).alias("state"), F.col("area_served").alias("area"), F.nullif("native_id", F.lit("7")).cast("long").alias("number"))
    kinds: dict[str, T.DataType] = {c: own.schema[c].dataType for c in ("state", "area", "number")}
    each: list[Column] = [f(F.col(c), k).alias(f"{c}_{name}") for c, k in kinds.items() for name, f in (("gap", is_gap), ("there", has_value))]
    return own.select("id", *each)
