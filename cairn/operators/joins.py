"""Joins that several checks share: equal sets of keys, values laid over rows, entries by either of two keys, allowed pairs and missing counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.scratch import broadcast_if


def key_sets(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: keys of the left table, those that both have, those that the right one lacks and has besides, and whether the sets are equal. Null keys and repeats don't count."""
    a, b = (t.select(key).where(F.col(key).isNotNull()).distinct() for t in (left, right))
    both = a.withColumn("a", F.lit(True)).join(b.withColumn("b", F.lit(True)), key, "full")
    there = F.col("a").isNotNull() & F.col("b").isNotNull()
    return both.agg(
        F.count("a").alias("known"), F.count_if(there).alias("matched"), F.count_if(F.col("b").isNull()).alias("missing"), F.count_if(F.col("a").isNull()).alias("unknown"), F.coalesce(F.bool_and(there), F.lit(True)).alias("equal")
    )


def overlaid(base: DataFrame, extra: DataFrame, key: str, column: str) -> DataFrame:
    """``base`` with values of ``extra`` (key, value) over a column, and ``overlaid``. All rows of the base stay, and a missing value doesn't replace one."""
    both = base.join(extra.select(key, F.col("value").alias("_over")), key, "left")
    return both.withColumn(column, F.coalesce("_over", column)).withColumn("overlaid", F.col("_over").isNotNull()).drop("_over")


def by_either_key(rows: DataFrame, entries: DataFrame, first: str, second: str) -> DataFrame:
    """``rows`` with the ``entry`` of (key, entry) that the first key finds, else the second: two equi-joins, no condition with OR."""
    one = entries.select(F.col("key").alias(first), F.col("entry").alias("_first"))
    two = entries.select(F.col("key").alias(second), F.col("entry").alias("_second"))
    return rows.join(one, first, "left").join(two, second, "left").withColumn("entry", F.coalesce("_first", "_second")).drop("_first", "_second")


def not_allowed(rows: DataFrame, allowed: DataFrame, *columns: str) -> DataFrame:
    """Rows whose values of the columns aren't a row of ``allowed``; a null is never allowed."""
    return rows.join(broadcast_if(allowed.select(*columns).distinct(), 20_000, cheap=True), list(columns), "left_anti")


def without_counterpart(rows: DataFrame, counterparts: DataFrame, key: str) -> DataFrame:
    """Rows to whose key no counterpart belongs."""
    return rows.join(counterparts.select(key).distinct(), key, "left_anti")


def repeated(rows: DataFrame, *columns: str) -> DataFrame:
    """Values of the columns that stand together in more than one row."""
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
