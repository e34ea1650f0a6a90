"""Queries over records and the search index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.text import SECRET_KEYS, plain_text, public_host, safe_public_url, shard, slug
from cairn.operators import index
from cairn.operators.gaps import evidence_score
from cairn.plans import sql
from cairn.plans.registry import query
from cairn.sources.records import corpus, corpus_of, corpus_order, distinct_records, first_of_each, records, table, with_ordinal

TEXT = "Worthless idiot documents: heention src3 thion"
TERMS = index.query_tokens(TEXT)
FIELDS_SQL = {
    "title": "title", "description": "notes", "topics": "array_to_string(list_concat(topics, tags), ' ')",
    "statistical": "concat_ws(' ', measure, unit_of_measure, population_type)", "geography_time": "array_to_string(area_served, ' ')", "producers": "publisher_title",
    "record_type": "record_type", "source": "source_surface", "identifiers": "id || ' ' || native_id",
}


def ranked_sql(where: str) -> str:
    fields = " UNION ALL ".join(f"SELECT id, {index.WEIGHTS[f]} AS w, unnest({sql.tokens(f'coalesce({x}, {chr(39) * 2})')}) AS token FROM r {where}" for f, x in FIELDS_SQL.items())
    return f"""WITH {sql.records()}, f AS ({fields}),
    s AS (SELECT id, count(DISTINCT token) AS matched, sum(w) AS score FROM f WHERE list_contains({sql.quoted(tuple(TERMS))}, token) GROUP BY id)
    SELECT id, title, CAST(matched AS INTEGER) AS matched, CAST(score AS INTEGER) AS score FROM s JOIN r USING (id) ORDER BY matched DESC, score DESC, lower(title), id LIMIT 10"""


@query(ranked_sql(""))
def search_ranked_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.ranked(records(spark, sf_dir), TEXT).select("id", "title", "matched", "score")


@query(ranked_sql("WHERE list_contains(topics, 'fr')"))
def search_filtered_lane(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = records(spark, sf_dir).where(F.array_contains("topics", "fr"))
    return index.ranked(own, TEXT).select("id", "title", "matched", "score")


def postings_sql(lanes: tuple[str, ...]) -> str:
    fields = " UNION ALL ".join(f"SELECT ordinal, {index.WEIGHTS[f]} AS w, {index.MASKS[f]} AS m, unnest({sql.tokens(f'coalesce({x}, {chr(39) * 2})')}) AS token FROM c" for f, x in FIELDS_SQL.items())
    return f"WITH {sql.corpus(*lanes)}, f AS ({fields}), p AS (SELECT token, ordinal, CAST(sum(w) AS BIGINT) AS score, bit_or(m) AS mask FROM f GROUP BY token, ordinal)"


INDEXED = tuple(sql.LANES)


@query(postings_sql(INDEXED) + " SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY token ORDER BY score DESC, ordinal) AS INTEGER) AS rank FROM p) WHERE rank <= 50")
def search_postings_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.top_postings(index.postings(corpus(spark, sf_dir, *INDEXED)), 50).select("token", "ordinal", "score", "mask", "rank")


def indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus without its order: counts need none."""
    return distinct_records(records(spark, sf_dir, *INDEXED))


@query(postings_sql(INDEXED) + f" SELECT token, count(*) AS df, {sql.shard('token')} AS shard FROM p GROUP BY token")
def lexicon_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.lexicon(index.tokens_of_records(indexed(spark, sf_dir)))


@query(
    postings_sql(INDEXED) + """, l AS (SELECT token, count(*) AS df FROM p GROUP BY token), e AS (SELECT left(token, n) AS prefix, token, df FROM (SELECT token, df, unnest(range(3, least(8, length(token)) + 1)) AS n FROM l WHERE length(token) >= 3))
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY prefix ORDER BY df DESC, token) AS INTEGER) AS rank FROM e) WHERE rank <= 16"""
)
def prefix_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.completions(lexicon_df(spark, sf_dir))


@query(postings_sql(INDEXED) + ", l AS (SELECT token, count(*) AS df FROM p GROUP BY token) SELECT count(*) AS tokens, CAST(sum(least(df, 5000)) AS BIGINT) AS postings, CAST(sum(df) AS BIGINT) AS uncapped_postings, CAST(max(df) AS BIGINT) AS largest, (SELECT count(*) FROM c) AS documents FROM l")
def index_manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = indexed(spark, sf_dir)
    words = index.lexicon(index.tokens_of_records(own))
    counts = words.agg(
        F.count(F.lit(1)).alias("tokens"), F.sum(F.least("df", F.lit(index.POSTINGS))).alias("postings"), F.sum("df").alias("uncapped_postings"), F.max("df").alias("largest")
    )
    return counts.withColumn("documents", F.lit(own.count()).cast("long"))


def facets_sql() -> str:
    from cairn.plans.gaps import SCORE_SQL

    one = lambda c: f"[nullif({c}, '')]"
    none = "CAST([] AS VARCHAR[])"
    own = dict.fromkeys(("subtopic", "geography_vintage", "derivation_mode", "binding_status", "has_alternatives"), none) | {
        "source_surface": one("source_surface"), "record_type": one("record_type"), "topic": "topics", "state": one("state"), "frequency": "[CAST(NULL AS VARCHAR)]",
        "population_type": one("population_type"), "source_publisher": one("publisher_title"), "unit_of_measure": one("unit_of_measure"), "geography_level": "area_served",
        "metadata_evidence_band": f"[CASE WHEN {SCORE_SQL} >= 0.8 THEN 'high' WHEN {SCORE_SQL} >= 0.55 THEN 'medium' ELSE 'low' END]", "has_methodology": "['no']",
        "has_quality_documentation": "[CASE WHEN len(quality_notes) > 0 THEN 'yes' ELSE 'no' END]",
    }
    each = " UNION ALL ".join(f"SELECT ordinal, '{k}' AS facet, list_distinct(list_filter({v}, lambda x: x IS NOT NULL AND x <> '')) AS v FROM c" for k, v in own.items())
    return f"WITH {sql.corpus()}, e AS ({each}), f AS (SELECT ordinal, facet, unnest(CASE WHEN len(v) > 0 THEN v ELSE ['__missing__'] END) AS value FROM e)"


@query(facets_sql() + " SELECT facet, value, count(*) AS n FROM f GROUP BY facet, value")
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = records(spark, sf_dir).withColumn("ordinal", F.lit(0))
    return index.facet_values(own, evidence_score()).groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


@query(facets_sql() + " SELECT facet, value, ordinal // 10000 AS block, count(*) AS n, string_agg(ordinal, ',' ORDER BY ordinal) AS ordinals FROM f GROUP BY facet, value, ordinal // 10000")
def filter_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = index.filter_postings(index.facet_values(corpus(spark, sf_dir), evidence_score()))
    return found.select("facet", "value", "block", F.size("ordinals").cast("long").alias("n"), F.array_join("ordinals", ",").alias("ordinals"))


WANTED = {"topic": ["en", "de"], "state": ["published", "restricted"], "has_quality_documentation": ["yes"]}


@query(facets_sql() + " SELECT ordinal FROM f WHERE " + " OR ".join(f"(facet = '{k}' AND value IN ({', '.join(map(repr, v))}))" for k, v in WANTED.items()) + f" GROUP BY ordinal HAVING count(DISTINCT facet) = {len(WANTED)}")
def facet_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that fit all of several facets, with any of the values wanted of each."""
    return index.conjunction(index.facet_values(corpus(spark, sf_dir), evidence_score()), WANTED)


@query(f"WITH {sql.corpus()} SELECT ordinal, ordinal // 500 AS chunk, id, title, left(notes, 2000) AS notes, {sql.slug('id')} AS name FROM c")
def result_documents_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("ordinal", F.floor(F.col("ordinal") / index.CHUNK).alias("chunk"), "id", "title", F.left("notes", F.lit(2000)).alias("notes"), "name")


@query(f"WITH {sql.records('parts', 'suppliers', 'customers')} SELECT id, title, source_surface FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY source_surface, id) AS n FROM (SELECT * FROM r UNION ALL SELECT * FROM r)) WHERE n = 1")
def records_union_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that occur twice, and parts that share a title: the first in the order of source and id stays."""
    own = records(spark, sf_dir, "parts", "suppliers", "customers").select("source_surface", "id", "title")
    return first_of_each(own.unionByName(own), "title", "source_surface", "id").select("id", "title", "source_surface")


@query(f"WITH {sql.records()} SELECT source_surface, count(*) AS n FROM r GROUP BY source_surface")
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).groupBy("source_surface").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {sql.records()} SELECT record_type, count(*) AS n FROM r GROUP BY record_type")
def record_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).groupBy("record_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {sql.records()} SELECT coalesce(publisher_title, 'unknown-source-publisher') AS publisher, count(*) AS n, min(source_surface || '|' || id) AS first_record FROM r GROUP BY 1")
def publisher_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = records(spark, sf_dir).withColumn("publisher", F.coalesce("publisher_title", F.lit("unknown-source-publisher")))
    return own.groupBy("publisher").agg(F.count(F.lit(1)).alias("n"), F.min(F.concat_ws("|", "source_surface", "id")).alias("first_record"))


@query(f"SELECT page_id, {sql.plain('html', 10_000)} AS body FROM pages")
def plain_text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", plain_text(F.col("html")).alias("body"))


@query(f"WITH {sql.records()} SELECT id, {sql.slug('coalesce(title, chr(32))')} AS slug, {sql.shard('title')} AS shard FROM r")
def slugs_and_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("id", slug(F.col("title")).alias("slug"), shard(F.col("title")).alias("shard"))


@query(f"SELECT {sql.HOST} AS host, count(*) AS n FROM pages GROUP BY 1")
def page_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").groupBy(public_host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


#: What is done to a URL to see whether it stays safe: nothing, another scheme, credentials, and each secret key, in small letters and capitals, with and without a value.
URL_CHANGES = ("", "scheme", "user", *(f"{k}=abc" for k in SECRET_KEYS), *(f"{k.upper()}=" for k in SECRET_KEYS), *SECRET_KEYS, "keys=1", "mytoken=1")


@query(f"""WITH u AS (SELECT page_id, x.change, CASE x.change WHEN '' THEN url WHEN 'scheme' THEN 'ftp' || url WHEN 'user' THEN replace(url, '://', '://u:p@')
 ELSE split_part(url, '#', 1) || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || x.change END AS url FROM pages, (SELECT unnest({list(URL_CHANGES)}) AS change) x)
SELECT page_id, change, regexp_matches(url, '^https?://[^/@?#]+(?:[/?#]|$)') AND NOT (change <> '' AND list_contains({list(SECRET_KEYS)}, lower(split_part(change, '=', 1)))) AND NOT regexp_matches(lower(url), '[?&]({"|".join(SECRET_KEYS)})(=|&|#|$)') AS safe FROM u""")
def safe_public_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' URLs, each as it is and changed in every way that makes one unsafe, and in two that don't."""
    change = F.col("change")
    own = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(F.array(*map(F.lit, URL_CHANGES))).alias("change"))
    asked = F.concat(F.split_part("url", F.lit("#"), F.lit(1)), F.when(F.contains("url", F.lit("?")), "&").otherwise("?"), change)
    user = F.replace("url", F.lit("://"), F.lit("://u:p@"))
    url = F.when(change == "", F.col("url")).when(change == "scheme", F.concat(F.lit("ftp"), "url")).when(change == "user", user).otherwise(asked)
    return own.select("page_id", "change", safe_public_url(url).alias("safe"))


BROWSER = "thion idiot the"


def browser_sql() -> str:
    fields = {"title": "title", "identifiers": "id || ' ' || native_id", "subjects": "array_to_string(list_concat(topics, tags), ' ')", "description": "notes", "context": "''"}
    low = {f: f"lower(coalesce({x}, ''))" for f, x in fields.items()}
    terms = BROWSER.split()
    score = " + ".join(f"CASE WHEN contains({low[f]}, '{t}') THEN {w} ELSE 0 END" for f, w in index.BROWSER_WEIGHTS.items() for t in terms)
    score += "".join(f" + CASE WHEN contains({low[f]}, '{BROWSER}') THEN {2 * w} ELSE 0 END" for f, w in index.BROWSER_WEIGHTS.items())
    every = " AND ".join("(" + " OR ".join(f"contains({x}, '{t}')" for x in low.values()) + ")" for t in terms)
    return f"WITH {sql.records()}, s AS (SELECT id, title, notes, {score} + CASE WHEN {every} THEN {index.BROWSER_ALL} ELSE 0 END AS score FROM r)"


@query(browser_sql() + " SELECT id, title, score FROM s WHERE score > 0 ORDER BY score DESC, title, id LIMIT 30")
def browser_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = index.browser_scored(records(spark, sf_dir), BROWSER).where("score > 0")
    return scored.orderBy(F.desc("score"), "title", "id").limit(30).select("id", "title", "score")


@query(f"""WITH {sql.corpus()}, s AS (SELECT id, title, ordinal, len(coalesce(notes, '')) AS size FROM c)
SELECT * FROM (SELECT 'title' AS menu, CAST(row_number() OVER (ORDER BY title, id) AS INTEGER) AS place, id FROM s UNION ALL SELECT 'size', CAST(row_number() OVER (ORDER BY size DESC, title, id) AS INTEGER), id FROM s
UNION ALL SELECT 'corpus', CAST(ordinal + 1 AS INTEGER), id FROM s) WHERE place <= 40""")
def ordered_menu_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first forty records in each of three orders; each order keeps its best rows in every task."""
    own = records(spark, sf_dir).select("id", "title", "source_surface", F.length(F.coalesce("notes", F.lit(""))).alias("size"))
    orders = {"title": [F.col("title"), F.col("id")], "size": [F.desc("size"), F.col("title"), F.col("id")], "corpus": corpus_order()}
    out = None
    for name, order in orders.items():
        best = with_ordinal(own.orderBy(*order).limit(40), *order, name="place")
        best = best.select(F.lit(name).alias("menu"), (F.col("place") + 1).cast("int").alias("place"), "id")
        out = best if out is None else out.unionAll(best)
    return out


@query(f"WITH {sql.corpus()} SELECT ordinal // 250 AS shard, count(*) AS nodes, CAST(sum(length(id)) AS BIGINT) AS characters, sha256(string_agg(id, ',' ORDER BY ordinal)) AS digest FROM c GROUP BY 1")
def chunk_shard_descriptor(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = corpus(spark, sf_dir).withColumn("shard", F.floor(F.col("ordinal") / 250))
    ids = F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "id"))), lambda x: x["id"])
    return own.groupBy("shard").agg(F.count(F.lit(1)).alias("nodes"), F.sum(F.length("id")).alias("characters"), F.sha2(F.array_join(ids, ","), 256).alias("digest"))


@query(f"WITH {sql.corpus()} SELECT ordinal, id, title FROM c")
def corpus_of_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus of records that all come three times, and of some copies under other titles that sort behind."""
    own = records(spark, sf_dir).select("source_surface", "title", "id", "native_id")
    copies = own.where("native_id % 3 = 0").withColumn("title", F.concat(F.coalesce("title", F.lit("~")), F.lit("~")))
    return corpus_of(own.unionAll(own).unionAll(own.where("title IS NOT NULL")).unionAll(copies.where("title <> '~~'"))).select("ordinal", "id", "title")
