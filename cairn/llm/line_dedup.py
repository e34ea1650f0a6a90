"""Line de-duplication over overlapping three-line windows.

Each run of three consecutive lines is hashed to 128 bits. Of equal windows, the one first in the order of
(doc_id with nulls last, text key, line) stays; the positions that the others cover are merged, and their lines go.
Lines are compared as they stand. Texts of fewer than three lines have no window and stay as they are, as do
null and empty ones. Rows with equal id and text are one document here and get equal results, also where the id is null.
A very long text is one row of lines, and one row of hashes for each of its windows. An empty table gives an empty result.
Further columns may have any name: those made on the way take names that the input leaves free.

Finding a window's first occurrence is a grouped minimum with partial aggregation, so a window that a third of
all documents hold costs one row per task. The later occurrences come from an equi-join of two shuffled tables, with
nothing between, of which Spark splits a partition that one window makes large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import free_name, materialize, table, text_key

LINES = 3


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(h1, h2, at) of every window; ``at`` orders occurrences: (is null, id, text key, first line)."""
    lines = F.col("lines")
    starts = F.sequence(F.lit(0), F.size(lines) - LINES)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    own = own.select("id", text_key(F.col("text")).alias("key"), lines_of(F.col("text")).alias("lines")).where(F.size("lines") >= LINES)

    def hashed(i: Column) -> Column:
        trio = [lines[i + k] for k in range(LINES)]
        return F.struct(F.xxhash64(*trio).alias("h1"), F.xxhash64(F.lit(LINES), *trio).alias("h2"))

    each = own.select("id", "key", F.posexplode(F.transform(starts, hashed)).alias("line", "w"))
    return each.select("w.h1", "w.h2", F.struct(F.isnull("id").alias("no_id"), "id", "key", "line").alias("at"))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, starts): sorted first lines of the windows that repeat an earlier one."""
    each = windows(docs, id_col, text_col)
    first = each.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.max("at").alias("last")).where(F.col("first") < F.col("last"))
    first = materialize(first.select("h1", "h2", "first"), "first-windows")
    later = each.join(first, ["h1", "h2"]).where(F.col("at") > F.col("first"))
    return later.groupBy("at.id", "at.key").agg(F.array_sort(F.collect_set("at.line")).alias("starts"))


def kept_lines(lines: Column, starts: Column) -> Column:
    """Lines that no window starting at ``starts`` covers: the gaps between one window's end and the next one's start."""
    ends = F.concat(F.array(F.lit(0)), F.transform(starts, lambda s: s + LINES))
    gaps = F.zip_with(ends, F.concat(starts, F.array(F.size(lines))), lambda a, b: F.slice(lines, a + 1, F.greatest(b - a, F.lit(0))))
    return F.flatten(gaps)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dropped: str = "n_removed_lines") -> DataFrame:
    """The documents with repeated lines taken out of the text, and how many went. A column of that name in the input gives way."""
    own = docs.select(*(docs[c] for c in docs.columns if c.lower() != dropped.lower()))
    id_, key, starts, kept = (free_name([*own.columns, dropped], c) for c in ("id", "key", "starts", "kept"))
    found = repeated(docs, id_col, text_col).select(F.col("id").alias(id_), F.col("key").alias(key), F.col("starts").alias(starts))
    both = own.join(found, own[id_col].eqNullSafe(F.col(id_)) & (text_key(own[text_col]) == F.col(key)), "left")
    both = both.withColumn(kept, F.when(F.col(starts).isNotNull(), kept_lines(lines_of(own[text_col]), F.col(starts))))
    text = F.when(F.col(kept).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    gone = F.when(F.col(kept).isNull(), F.lit(0)).otherwise(F.size(lines_of(F.col(text_col))) - F.size(kept))
    return both.select(*(text.alias(c) if c == text_col else F.col(c) for c in own.columns), gone.cast("long").alias(dropped))


def drop_repeated_lines(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents without repeated lines, with a count of characters brought up to date; those that lost all their lines are left out."""
    removed = free_name(docs.columns, "removed")
    kept = dedup_lines(docs, text_col=text_col, dropped=removed).where((F.col(removed) == 0) | (F.trim(text_col) != "") | F.col(text_col).isNull())
    if chars_col in docs.columns:
        size = F.when(F.col(removed) > 0, F.length(text_col)).otherwise(F.col(chars_col))
        kept = kept.withColumn(chars_col, size.cast(docs.schema[chars_col].dataType))
    return kept.select(docs.columns)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_lines = F.coalesce(F.size(lines_of(F.col("text"))), F.lit(0)).cast("long")
    return dedup_lines(docs).select("doc_id", n_lines.alias("n_kept_lines"), F.col("n_removed_lines"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


OP3_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, text, sha256(text)[1:32] AS k, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, k, p, l[p + 1] || chr(10) || l[p + 2] || chr(10) || l[p + 3] AS g FROM (SELECT *, unnest(range(0, len(l) - 2)) AS p FROM d WHERE len(l) >= 3)),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS LAST, k, p) AS n FROM w),
gone AS (SELECT DISTINCT doc_id, k, unnest([p + 1, p + 2, p + 3]) AS q FROM r WHERE n > 1),
ln AS (SELECT doc_id, k, l[q] AS line, q FROM (SELECT *, unnest(range(1, len(l) + 1)) AS q FROM d)),
kept AS (SELECT doc_id, k, string_agg(line, chr(10) ORDER BY q) AS t, count(*) AS n FROM ln LEFT JOIN gone USING (doc_id, k, q) WHERE gone.q IS NULL GROUP BY doc_id, k),
lost AS (SELECT doc_id, k, count(*) AS n FROM gone GROUP BY doc_id, k),
out AS (SELECT d.doc_id, d.text, coalesce(kept.t, '') AS t, coalesce(lost.n, 0) AS n_lost FROM d LEFT JOIN lost USING (doc_id, k) LEFT JOIN kept USING (doc_id, k))
SELECT s.doc_id, CAST(coalesce(len(string_split(out.t, chr(10))), 0) AS BIGINT) AS n_kept_lines, CAST(coalesce(n_lost, 0) AS BIGINT) AS n_removed_lines, sha256(coalesce(t, '')) AS text_sha256
FROM documents s LEFT JOIN out ON out.doc_id IS NOT DISTINCT FROM s.doc_id AND out.text = s.text
"""
