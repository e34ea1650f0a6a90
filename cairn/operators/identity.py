"""Identities of records: lookup with precedence, aliases and side-by-side comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Precedence of what a key may be: the id, the source's own id, then the title.
KEYS = {"id": 1, "native_id": 2, "title": 3}


def identities(records: DataFrame) -> DataFrame:
    """(key, priority, matches, first_id): for each case-folded key the records that own it at its best precedence."""
    own = F.array(*(F.struct(F.lower(c).alias("key"), F.lit(p).alias("priority")) for c, p in KEYS.items()))
    rows = records.select("id", F.explode(own).alias("k")).select("k.key", "k.priority", "id").where("key IS NOT NULL AND key <> ''").distinct()
    counts = rows.groupBy("key", "priority").agg(F.count(F.lit(1)).alias("matches"), F.min("id").alias("first_id"))
    best = counts.groupBy("key").agg(F.min(F.struct("priority", "matches", "first_id")).alias("b"))
    return best.select("key", "b.priority", "b.matches", "b.first_id")


def lookup(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(wanted, outcome, id) of each identifier asked for: FOUND, AMBIGUOUS or NOT_FOUND."""
    both = wanted.join(index, F.lower("wanted") == F.col("key"), "left")
    outcome = F.when(F.col("matches").isNull(), "NOT_FOUND").when(F.col("matches") > 1, "AMBIGUOUS").otherwise("FOUND")
    return both.select("wanted", outcome.alias("outcome"), F.when(F.col("matches") == 1, F.col("first_id")).alias("id"))


def alias_resolution(aliases: DataFrame, records: DataFrame) -> DataFrame:
    """(alias, target, resolved, title): aliases with the record that they name, if there is one."""
    both = aliases.join(records.select(F.col("id").alias("_id"), "title"), F.col("target") == F.col("_id"), "left")
    return both.select("alias", "target", F.col("_id").isNotNull().alias("resolved"), "title")


def as_text(records: DataFrame, name: str) -> Column:
    return F.array_join(name, ",") if records.schema[name].dataType.typeName() == "array" else F.col(name).cast("string")


def compare(records: DataFrame, ids: tuple[str, ...], fields: list[str]) -> DataFrame:
    """(field, different, values) of two to five records."""
    if not 2 <= len(set(ids)) <= 5 or len(set(ids)) != len(ids):
        raise ValueError("two to five distinct records can be compared")
    values = F.array(*(F.struct(F.lit(f).alias("field"), F.nullif(as_text(records, f), F.lit("")).alias("value")) for f in fields))
    rows = records.where(F.col("id").isin(*ids)).select("id", F.explode(values).alias("v")).select("id", "v.field", "v.value")
    shown = F.transform(F.sort_array(F.collect_list(F.struct("id", "value"))), lambda x: F.concat(x["id"], F.lit("="), F.coalesce(x["value"], F.lit(""))))
    return rows.groupBy("field").agg((F.countDistinct(F.coalesce("value", F.lit("\x01"))) > 1).alias("different"), F.array_join(shown, ";").alias("values"))
