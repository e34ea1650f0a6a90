"""Coverage ledgers, digests, samples, snapshots and sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.values import epoch_timestamp


def coverage(pages: DataFrame) -> DataFrame:
    """Per source: represented, dropped and unrepresented rows, and whether all pages were complete. pages: (source, page, seen, normalised, reported)."""
    sums = pages.groupBy("source").agg(
        F.sum("seen").alias("seen"), F.sum("normalised").alias("represented"), F.max("reported").alias("reported"), F.bool_and(F.col("seen") == F.col("normalised")).alias("complete")
    )
    zero = F.lit(0).cast("long")
    return sums.select(
        "source", "represented", F.greatest(F.col("seen") - F.col("represented"), zero).alias("dropped"), F.greatest(F.col("reported") - F.col("represented"), zero).alias("unrepresented"), "complete"
    )


#: Hexadecimal digits of a hash by which a set is digested, level by level: a node of the tree joins 256 digests of the level below.
LEVELS = (6, 4, 2, 0)


def set_digest(rows: DataFrame, by: str, key: Column) -> DataFrame:
    """(by, n, digest) of the set of keys of each group: keys are hashed, sorted and digested within prefixes of their hash, and these digests again.

    16.8 million prefixes keep what one row gathers small, also where one group holds most keys. The keys' hashes are shuffled once, as bytes: they become a set where they are gathered.
    """
    hashes = rows.select(by, F.unhex(F.sha2(key, 256)).alias("h"))
    gathered = hashes.groupBy(by, F.substring("h", 1, LEVELS[0] // 2).alias("p")).agg(F.collect_set(F.coalesce("h", F.lit(b""))).alias("set"))
    texts = F.transform(F.sort_array("set"), lambda x: F.lower(F.hex(x)))
    parts = gathered.select(by, F.lower(F.hex("p")).alias("h"), F.sha2(F.array_join(texts, ","), 256).alias("digest"), F.size("set").cast("long").alias("n"))
    for digits in LEVELS[1:]:
        own = F.transform(F.sort_array(F.collect_list(F.struct("h", "digest"))), lambda x: x["digest"])
        parts = parts.groupBy(by, F.left("h", F.lit(digits)).alias("h")).agg(F.sha2(F.array_join(own, ","), 256).alias("digest"), F.sum("n").alias("n"))
    return parts.select(by, "n", "digest")


def hash_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows whose keys have the least SHA-256, in that order."""
    return rows.withColumn("digest", F.sha2(F.col(key).cast("string"), 256)).orderBy("digest", key).limit(n)


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, old, new): values that differ, and added or removed rows as field ``*``."""
    side = lambda df, name: df.select(key, F.struct(*(F.col(f).cast("string").alias(f) for f in fields)).alias(name))
    both = side(before, "old").join(side(after, "new"), key, "full")
    each = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"old.{f}").alias("old"), F.col(f"new.{f}").alias("new")) for f in fields))
    gone = F.array(F.struct(F.lit("*").alias("field"), F.when(F.col("old").isNotNull(), "present").alias("old"), F.when(F.col("new").isNotNull(), "present").alias("new")))
    rows = both.select(key, F.explode(F.when(F.col("old").isNull() | F.col("new").isNull(), gone).otherwise(each)).alias("d")).select(key, "d.*")
    return rows.where(~F.col("old").eqNullSafe(F.col("new")))


def outside_allowlist(diff: DataFrame, allowed: list[str]) -> DataFrame:
    """Changes that a bounded replacement may not make; none may remain."""
    return diff.where(~F.col("field").isin(*allowed))


def sequence_gaps(events: DataFrame, group: str, number: str) -> DataFrame:
    """(group, expected, found): first number of each group that isn't its place in order, counted from zero."""
    placed = events.withColumn("expected", F.row_number().over(Window.partitionBy(group).orderBy(number)) - 1).where(F.col("expected") != F.col(number))
    return placed.groupBy(group).agg(F.min(F.struct("expected", number)).alias("x")).select(group, "x.expected", F.col(f"x.{number}").alias("found"))


def normalised_epochs(rows: DataFrame, value: str) -> DataFrame:
    return rows.withColumn("at", F.date_format(epoch_timestamp(F.col(value)), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def month_extent(rows: DataFrame, by: str, at: str) -> DataFrame:
    """First and last month of each group."""
    month = F.date_format(at, "yyyy-MM")
    return rows.groupBy(by).agg(F.min(month).alias("first_month"), F.max(month).alias("last_month"), F.max(at).cast("string").alias("latest"))
