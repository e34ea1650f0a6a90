"""Queries over frozen snapshots: their digests, and the faults of a copy with planted defects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import snapshot
from cairn.operators.ledger import LEVELS
from cairn.plans import sql
from cairn.plans.registry import query
from cairn.sources.records import records

#: Ids in a file, and on a page of it: a page has one receipt.
IN_FILE, ON_PAGE = 100, 25

FILES_SQL = f"""{sql.records()}, rows AS (
    SELECT format('{{}}-{{:05d}}.jsonl', source_surface, k // {IN_FILE}) AS file, source_surface AS source_id, k, k // {IN_FILE} AS f, id, concat_ws('|', id, coalesce(title, ''), coalesce(url, '')) AS content
    FROM (SELECT *, CAST(native_id AS BIGINT) AS k FROM r)
), receipts AS (SELECT file, any_value(f) AS f, (k % {IN_FILE}) // {ON_PAGE} AS page, 'https://pages.example/' || file || '?page=' || (k % {IN_FILE}) // {ON_PAGE} AS url, sha256(CAST(count(*) AS VARCHAR)) AS content FROM rows GROUP BY file, (k % {IN_FILE}) // {ON_PAGE})"""


def filed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by the file that would hold them: a hundred ids of a lane."""
    k = F.col("native_id").cast("long")
    content = F.concat_ws("|", "id", F.coalesce("title", F.lit("")), F.coalesce("url", F.lit("")))
    return records(spark, sf_dir).select(
        F.format_string("%s-%05d.jsonl", "source_surface", F.floor(k / IN_FILE)).alias("file"), F.col("source_surface").alias("source_id"), k.alias("k"), F.floor(k / IN_FILE).alias("f"), "id", content.alias("content")
    )


def receipts_of(rows: DataFrame) -> DataFrame:
    """Page receipts: an address and a digest for each page."""
    page = F.floor(F.col("k") % IN_FILE / ON_PAGE)
    own = rows.groupBy("file", page.alias("page")).agg(F.min("f").alias("f"), F.count(F.lit(1)).alias("n"))
    return own.select("file", "f", "page", F.concat(F.lit("https://pages.example/"), "file", F.lit("?page="), F.col("page").cast("string")).alias("url"), F.sha2(F.col("n").cast("string"), 256).alias("content"))


def receipt_tree(receipts: DataFrame) -> snapshot.Tree:
    return snapshot.digest_tree(receipts, F.col("page").cast("string"), F.concat_ws(" ", "url", "content"))


def tree_sql(name: str, leaves: str) -> str:
    """Common tables from ``leaves`` (file, h, digest) to ``name`` (file, n, digest)."""
    out, last = f"{name}_all AS (SELECT *, 1 AS n FROM {leaves})", f"{name}_all"
    for digits in LEVELS:
        own = f"{name}_{digits}" if digits else name
        out += f", {own} AS (SELECT file, left(h, {digits}) AS h, sha256(string_agg(digest, ',' ORDER BY h)) AS digest, CAST(sum(n) AS BIGINT) AS n FROM {last} GROUP BY file, left(h, {digits}))"
        last = own
    return out


@query(
    f"""WITH {FILES_SQL}, a AS (SELECT DISTINCT file, sha256(id) AS h, sha256(content) AS digest FROM rows), {tree_sql('ta', 'a')},
    b AS (SELECT file, sha256(CAST(page AS VARCHAR)) AS h, sha256(url || ' ' || content) AS digest FROM receipts), {tree_sql('tb', 'b')}
    SELECT s.file, s.source_id, ta.n AS records, ta.digest AS record_set, tb.n AS receipts, tb.digest AS receipt_set, CAST(0 AS BIGINT) AS incomplete, sha256(concat_ws(chr(10), s.source_id, ta.n, ta.digest, tb.digest)) AS digest
    FROM (SELECT DISTINCT file, source_id FROM rows) s JOIN ta USING (file) JOIN tb USING (file)"""
)
def snapshot_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a register of all records' files says: counts, sets of records and of page receipts, and the digest of each file."""
    rows = filed(spark, sf_dir)
    own = snapshot.digest_tree(rows, F.col("id"), F.col("content"))
    return snapshot.recount(rows.select("file", "source_id").distinct(), own, receipt_tree(receipts_of(rows)))


#: Planted in a copy, by numbers of ids (k) and files (f).
CHANGED, REMOVED, LOST, MISCOUNTED, MISNAMED, REFETCHED, BLANK = "k % 211 = 7", "k % 223 = 9", "f % 7 = 1", "f % 5 = 0", "f % 11 = 0", "f % 13 = 0 AND page = 1", "f % 17 = 0 AND page = 0"

DAMAGED_SQL = f"""{FILES_SQL}, files AS (
    SELECT file, any_value(f) AS f, count(*) AS n, count(*) FILTER ({REMOVED}) AS removed, count(*) FILTER ({CHANGED}) AS changed FROM rows GROUP BY file
), touched AS (SELECT file, bool_or({REFETCHED} OR {BLANK}) AS touched, bool_or({BLANK}) AS blank FROM receipts GROUP BY file
), flags AS (SELECT *, removed + changed > 0 AS other FROM files JOIN touched USING (file)
), rules AS (
    SELECT file, unnest(CASE WHEN {LOST} OR n = removed THEN ['file is missing'] ELSE list_filter([
        CASE WHEN {MISNAMED} THEN 'source identity' END, CASE WHEN removed > 0 OR {MISCOUNTED} THEN 'stated record count' END, CASE WHEN removed > 0 THEN 'registered record count' END,
        CASE WHEN other THEN 'stated record set' END, CASE WHEN other THEN 'registered record set' END, CASE WHEN blank THEN 'incomplete receipt' END, CASE WHEN touched THEN 'stated receipt set' END,
        CASE WHEN touched THEN 'registered receipt set' END, CASE WHEN other OR touched THEN 'file digest' END], lambda x: x IS NOT NULL) END) AS fault
    FROM flags
)"""


@query(
    f"""WITH {DAMAGED_SQL} SELECT file, fault, CAST(NULL AS VARCHAR) AS key FROM rules
    UNION ALL SELECT rows.file, CASE WHEN {REMOVED} THEN 'record missing' ELSE 'record changed' END, id FROM rows JOIN files USING (file) WHERE NOT (files.{LOST}) AND n > removed AND ({CHANGED} OR {REMOVED})
    UNION ALL SELECT receipts.file, 'receipt changed', CAST(page AS VARCHAR) FROM receipts JOIN files USING (file) WHERE NOT (files.{LOST}) AND n > removed AND (receipts.{REFETCHED} OR receipts.{BLANK})"""
)
def snapshot_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of a damaged copy: what each file breaks, and the records and receipts at the bottom of it.

    Records were changed and removed, whole files lost, and receipts fetched anew or left blank; some files state a wrong count or another source.
    """
    rows = filed(spark, sf_dir)
    before, pages = snapshot.digest_tree(rows, F.col("id"), F.col("content")), receipts_of(rows)
    before_pages = receipt_tree(pages)
    registered = snapshot.recount(rows.select("file", "source_id").distinct(), before, before_pages)
    number = rows.groupBy("file").agg(F.min("f").alias("f"))
    stated = registered.join(number, "file").withColumns({
        "records": F.when(F.expr(MISCOUNTED), F.col("records") + 1).otherwise(F.col("records")), "source_id": F.when(F.expr(MISNAMED), "another").otherwise(F.col("source_id"))}).drop("f")
    left = rows.where(f"NOT ({LOST}) AND NOT ({REMOVED})").withColumn("content", F.when(F.expr(CHANGED), F.concat("content", F.lit("!"))).otherwise(F.col("content")))
    kept = left.select("file").distinct()
    fetched = pages.join(kept, "file", "left_semi").withColumns({"content": F.when(F.expr(REFETCHED), F.sha2("content", 256)).otherwise(F.col("content")), "url": F.when(~F.expr(BLANK), F.col("url"))})
    after, after_pages = snapshot.digest_tree(left, F.col("id"), F.col("content")), receipt_tree(fetched)
    incomplete = fetched.groupBy("file").agg(F.count_if(F.col("url").isNull() | F.col("content").isNull()).alias("incomplete"))
    found = snapshot.recount(left.select("file", "source_id").distinct(), after, after_pages, incomplete)
    deep = [snapshot.descend(a, b).select("file", F.concat(F.lit(what + " "), "fault").alias("fault"), "key") for what, a, b in (("record", before, after), ("receipt", before_pages, after_pages))]
    return snapshot.file_faults(registered, stated, found).select("file", F.col("rule").alias("fault"), F.lit(None).cast("string").alias("key")).unionAll(deep[0]).unionAll(deep[1])


@query(
    f"""WITH {sql.records()}, h AS (SELECT source_surface AS snapshot_id, count(DISTINCT native_id) AS counted, count(*) + CASE WHEN source_surface = 'pages' THEN 1 ELSE 0 END AS total FROM r GROUP BY source_surface)
    SELECT CASE snapshot_id WHEN 'parts' THEN '' ELSE snapshot_id END AS snapshot_id, rule FROM h JOIN (VALUES ('documents', 'schema'), ('pages', 'unique records'), ('parts', 'snapshot id'), ('suppliers', 'metadata_only'), ('customers', 'observations_included')) v(lane, rule) ON lane = snapshot_id"""
)
def snapshot_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of a snapshot for each lane, each with another defect."""
    lane = F.col("source_surface")
    counted = records(spark, sf_dir).groupBy(lane).agg(F.countDistinct("id").alias("counted"), F.count(F.lit(1)).alias("n"))
    headers = counted.select(
        F.when(lane == "parts", "").otherwise(lane).alias("snapshot_id"), F.when(lane == "documents", "frozen-snapshot.v0").otherwise("frozen-snapshot.v1").alias("schema"), (lane != "suppliers").alias("metadata_only"),
        (lane == "customers").alias("observations_included"), F.lit(1).alias("files"), (F.col("n") + F.when(lane == "pages", 1).otherwise(0)).alias("total"), "counted",
    )
    return snapshot.header_faults(headers)


@query(
    f"""WITH {FILES_SQL} SELECT file, page, CASE WHEN {LOST} AND page > 1 THEN 'missing' ELSE 'changed' END AS fault FROM receipts WHERE ({LOST} AND page > 1) OR ({REFETCHED})"""
)
def snapshot_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts of a base snapshot that its successor, which adds a page to each file, lost or changed."""
    base = receipts_of(filed(spark, sf_dir))
    kept = base.where(f"NOT ({LOST} AND page > 1)").withColumn("content", F.when(F.expr(REFETCHED), F.sha2("content", 256)).otherwise(F.col("content")))
    more = base.groupBy("file").agg((F.max("page") + 1).alias("page")).select("file", "page", F.lit("https://pages.example/more").alias("url"), F.sha2("file", 256).alias("content"))
    return snapshot.lineage_faults(base, kept.select("file", "page", "url", "content").unionByName(more))
