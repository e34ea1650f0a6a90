"""SQL fragments for the queries' counterparts: token lists, plain text and the record lanes."""

from __future__ import annotations

from cairn.functions.text import SEARCH_PATTERN, SEARCH_STOP_WORDS, SIMILARITY_PATTERN, SIMILARITY_STOP_WORDS
from cairn.operators.ledger import LEVELS


def quoted(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def fold(x: str) -> str:
    return f"replace(lower(strip_accents({x})), 'ß', 'ss')"


def tokens(x: str) -> str:
    found = f"list_transform(regexp_extract_all({fold(x)}, '{SEARCH_PATTERN}'), lambda t: trim(t, '._-'))"
    return f"list_distinct(list_filter({found}, lambda t: length(t) >= 2 AND NOT list_contains({quoted(SEARCH_STOP_WORDS)}, t)))"


def similarity(x: str) -> str:
    pattern = SIMILARITY_PATTERN.replace("'", "''")
    return f"list_filter(regexp_extract_all(replace(lower({x}), 'ß', 'ss'), '{pattern}'), lambda t: NOT list_contains({quoted(SIMILARITY_STOP_WORDS)}, t))"


def bounded(x: str, limit: int) -> str:
    return f"(CASE WHEN length({x}) > {limit} THEN rtrim(left({x}, {limit - 1})) || '…' ELSE {x} END)"


def plain(x: str, limit: int) -> str:
    """Of named entities only those that the test tables hold."""
    text = x
    for name, sign in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{sign}')"
    text = f"regexp_replace({text}, '(?is)<script.*?</script>|<style.*?</style>', ' ', 'g')"
    text = f"regexp_replace({text}, '(?s)<[^>]+>', ' ', 'g')"
    text = f"replace(replace({text}, '\\r\\n', ' '), '\\n', ' ')"
    return bounded(f"trim(regexp_replace({text}, '[\\s]+', ' ', 'g'))", limit)


HOST = "lower(nullif(regexp_extract(url, '^https?://([^/:?#]+)', 1), ''))"
NONE = "CAST([] AS VARCHAR[])"


def lane(source: str, **given: str) -> str:
    defaults = dict.fromkeys(("title", "notes", "url", "host", "publisher_title", "license_id", "state", "population_type", "measure", "unit_of_measure", "declared_code"), "CAST(NULL AS VARCHAR)")
    defaults |= dict.fromkeys(("topics", "tags", "area_served", "quality_notes"), NONE)
    columns = defaults | given
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in sorted(columns.items())) + f" FROM {source}"


PLACES = "(SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"
LANES = {
    "documents": lane(
        "documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)",
        id="'documents:' || doc_id", native_id="CAST(doc_id AS VARCHAR)", title="left(split_part(text, chr(10), 1), 1000)", notes="text", record_type="'Document'", source_surface="'documents'",
        topics="[lang]", publisher_title="source", license_id="nullif(regexp_extract(text, 'Licensed under (?:the )?([A-Z][A-Za-z0-9 -]*)', 1), '')",
        quality_notes=f"CASE WHEN quality IS NULL THEN {NONE} ELSE ['labelled quality ' || quality] END", state="CASE toxic WHEN 1 THEN 'restricted' WHEN 0 THEN 'published' END",
    ),
    "pages": lane(
        "pages", id="'pages:' || page_id", native_id="CAST(page_id AS VARCHAR)", title=plain("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)", 1000), notes=plain("html", 10_000),
        record_type="'Page'", source_surface="'pages'", topics="[regexp_extract(html, '<html lang=\"([a-z]*)\"', 1)]", url="url", host=HOST, publisher_title=HOST,
    ),
    "parts": lane(
        "part", id="'parts:' || p_partkey", native_id="CAST(p_partkey AS VARCHAR)", title="p_name", record_type="'Part'", source_surface="'parts'", tags="[p_brand, p_type]",
        unit_of_measure="CAST(p_size AS VARCHAR)", measure="p_type", publisher_title="p_brand", declared_code="p_brand || '-' || p_size",
    ),
    "suppliers": lane(
        f"supplier JOIN {PLACES} ON s_nationkey = n_nationkey", id="'suppliers:' || s_suppkey", native_id="CAST(s_suppkey AS VARCHAR)", title="s_name", record_type="'Supplier'",
        source_surface="'suppliers'", topics="[n_name]", area_served="[r_name]", publisher_title="n_name",
    ),
    "customers": lane(
        f"customer JOIN {PLACES} ON c_nationkey = n_nationkey", id="'customers:' || c_custkey", native_id="CAST(c_custkey AS VARCHAR)", title="c_name", record_type="'Customer'",
        source_surface="'customers'", topics="[c_mktsegment]", area_served="[r_name]", publisher_title="n_name", population_type="c_mktsegment",
    ),
}


def records(*lanes: str) -> str:
    """A common table ``r`` of the lanes, as a clause of WITH."""
    return "r AS (" + " UNION ALL ".join(LANES[x] for x in lanes or LANES) + ")"


def corpus(*lanes: str) -> str:
    """``r`` and, with ordinals, ``c``."""
    return records(*lanes) + ", c AS (SELECT *, row_number() OVER (ORDER BY source_surface, lower(title), id) - 1 AS ordinal FROM r)"


def set_digest(by: str, hashes: str) -> str:
    """Common tables from ``hashes`` (by, h) to ``digests`` (by, n, digest): digests of sorted digests, by ever shorter prefixes of the hash."""
    out, last = f"d0 AS (SELECT DISTINCT {by}, h, h AS digest, 1 AS n FROM {hashes})", "d0"
    for k, digits in enumerate(LEVELS, 1):
        out += f", d{k} AS (SELECT {by}, left(h, {digits}) AS h, sha256(string_agg(digest, ',' ORDER BY h)) AS digest, CAST(sum(n) AS BIGINT) AS n FROM {last} GROUP BY {by}, left(h, {digits}))"
        last = f"d{k}"
    return out + f", digests AS (SELECT {by}, n, digest FROM {last})"


def shard(x: str) -> str:
    return f"coalesce(nullif(left(regexp_replace(lower({x}), '[^a-z0-9]', '', 'g'), 2), ''), '_')"


def slug(x: str) -> str:
    words = f"trim(regexp_replace(replace(lower({plain(x, 500)}), 'ß', 'ss'), '[^a-z0-9]+', '-', 'g'), '-')"
    return f"rtrim(left(coalesce(nullif({words}, ''), 'record'), 180), '-')"
