"""How records of a provider drift: three states held against each other, field by field, with the time at which a value was first seen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.validate import violations


def classified(selected: Column, observed: Column, baseline: Column) -> Column:
    """What became of a field since the baseline, in the snapshot and at the provider; null where nothing did."""
    s, o, b = selected, observed, baseline
    return (
        F.when(s.eqNullSafe(o) & s.eqNullSafe(b), None).when(s.eqNullSafe(b), "provider-changed").when(o.eqNullSafe(b), "snapshot-changed").when(s.eqNullSafe(o), "both-changed-alike").otherwise("conflicting")
    )


def drift(selected: DataFrame, observed: DataFrame, baseline: DataFrame, key: str, fields: list[str], history: DataFrame | None = None) -> DataFrame:
    """(key, field, drift, selected, observed, baseline, first_seen): fields that differ between the three states, which hold a key once each.

    Records that only one of snapshot and provider has are named once, as field ``*``. ``history`` (key, field, value, seen) tells when values were observed;
    ``first_seen`` is the least time at which the observed value was.
    """
    side = lambda df, name: df.select(key, F.struct(*(F.col(f).cast("string").alias(f) for f in fields)).alias(name))
    rows = side(selected, "s").join(side(observed, "o"), key, "full").join(side(baseline, "b"), key, "left")
    text = lambda x: F.lit(None).cast("string") if x is None else x
    one = lambda field, drift, s=None, o=None, b=None: F.struct(F.lit(field).alias("field"), drift.alias("drift"), text(s).alias("selected"), text(o).alias("observed"), text(b).alias("baseline"))
    gone, new = one("*", F.lit("gone-at-provider")), one("*", F.when(F.col("b").isNull(), "new-at-provider").otherwise("dropped-from-snapshot"))
    each = F.array(*(one(f, classified(F.col(f"s.{f}"), F.col(f"o.{f}"), F.col(f"b.{f}")), F.col(f"s.{f}"), F.col(f"o.{f}"), F.col(f"b.{f}")) for f in fields))
    unbased = F.array(*(one(f, F.when(~F.col(f"s.{f}").eqNullSafe(F.col(f"o.{f}")), "without-baseline"), F.col(f"s.{f}"), F.col(f"o.{f}")) for f in fields))
    found = F.when(F.col("o").isNull(), F.array(gone)).when(F.col("s").isNull(), F.array(new)).when(F.col("b").isNull(), unbased).otherwise(each)
    out = rows.select(key, F.explode(found).alias("d")).select(key, "d.*").where("drift IS NOT NULL")
    if history is None:
        return out.withColumn("first_seen", F.lit(None).cast("string"))
    seen = history.groupBy(key, "field", F.col("value").alias("observed")).agg(F.min("seen").alias("first_seen"))
    return out.join(seen, [key, "field", "observed"], "left").select(key, "field", "drift", "selected", "observed", "baseline", "first_seen")


def select_pack(records: DataFrame, packs: DataFrame, fields: list[str]) -> DataFrame:
    """(pack, *record columns): the records that each pack's selector (pack, field, operator, value) takes, which must be an equality on one of the fields.

    Fields become rows, so a join on field and value serves all packs, whatever field they name.
    """
    named = [records.withColumn("value", F.col(f).cast("string")).withColumn("field", F.lit(f)) for f in fields]
    wanted = packs.where("operator = 'equals'").select("pack", "field", "value")
    return reduce(DataFrame.unionAll, named).join(wanted, ["field", "value"]).select("pack", *records.columns)


def pack_faults(packs: DataFrame, selected: DataFrame, key: str, drifted: DataFrame) -> DataFrame:
    """(pack, rule) of packs (pack, field, operator, expected, commit, live_commit, live_status): counts, commits and drift that they declare against what was found.

    ``selected`` are (pack, key, commit), ``drifted`` the packs' drift (pack, ...).
    """
    counts = selected.groupBy("pack").agg(F.count(F.lit(1)).alias("found"), F.countDistinct(key).alias("keys"), F.min("commit").alias("low"), F.max("commit").alias("high"), F.count("commit").alias("committed"))
    differing = drifted.groupBy("pack").agg(F.count(F.lit(1)).alias("differences"))
    rows = packs.join(counts, "pack", "left").join(differing, "pack", "left")
    some = F.col("found").isNotNull()
    rules = {
        "selector": F.col("operator") == "equals", "selector matches nothing": (F.col("operator") != "equals") | some, "record count": ~some | (F.col("found") == F.col("expected")), "record ids repeat": ~some | (F.col("keys") == F.col("found")),
        "source commit": ~some | (F.col("low") == F.col("commit")) & (F.col("high") == F.col("commit")) & (F.col("committed") == F.col("found")), "reference status": F.col("live_status") == "reviewed-reference-not-live-validated",
        "drift without a difference": ~some | (F.coalesce("differences", F.lit(0)) > 0), "drift without another commit": F.col("live_commit") != F.col("commit"),
    }
    return violations(rows, "pack", rules)
