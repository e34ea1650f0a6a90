"""How fields of a record came about: maps of details by field, merged from several sources with a fixed precedence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions.text import plain_text
from cairn.functions.values import is_gap

FIELDS = "map<string,map<string,string>>"
MODE = 300


def merged_fields(prior: Column, later: Column) -> Column:
    """Details of both, by field and then by key; where both have a key, the prior's value stays, even if it is null. Associative; an empty map changes nothing."""
    none, empty = F.map_from_arrays(F.array(), F.array()).cast("map<string,string>"), F.map_from_arrays(F.array(), F.array()).cast(FIELDS)
    inner = lambda a, b: F.map_zip_with(a, b, lambda k, x, y: F.when(F.map_contains_key(a, k), x).otherwise(y))
    return F.map_zip_with(F.coalesce(prior, empty), F.coalesce(later, empty), lambda _, x, y: inner(F.coalesce(x, none), F.coalesce(y, none)))


def modes_of(given: Column, fields: Column) -> Column:
    """Distinct modes, those given and those of the fields, as plain text in order; blank ones don't count."""
    own = F.transform(F.map_values(fields), lambda d: F.element_at(d, "mode"))
    every = F.transform(F.concat(F.coalesce(given, F.array().cast("array<string>")), own), lambda m: plain_text(m, MODE))
    return F.sort_array(F.array_distinct(F.filter(every, lambda m: F.coalesce(m != "", F.lit(False)))))


def merge(parts: DataFrame, key: str = "id") -> DataFrame:
    """(key, modes, fields) of all parts (key, rank, modes, fields) of a record, in whatever order and partitions they come.

    Of the values that several parts give one key of a field, that of the least rank stays; parts of one rank go by their texts. A record has as many parts as
    there are sources, so a fold sees few.
    """
    part = F.struct("rank", F.to_json("fields").alias("text"), F.coalesce("modes", F.array().cast("array<string>")).alias("modes"), F.struct("fields").alias("own"))
    before = lambda a, b: F.when(a["rank"] != b["rank"], F.signum(a["rank"] - b["rank"])).when(a["text"] < b["text"], -1).when(a["text"] > b["text"], 1).otherwise(0).cast("int")
    listed = parts.groupBy(key).agg(F.array_sort(F.collect_list(part), before).alias("parts"))
    empty = F.map_from_arrays(F.array(), F.array()).cast(FIELDS)
    fields = F.aggregate("parts", empty, lambda acc, p: merged_fields(acc, p["own"]["fields"]))
    folded = listed.select(key, F.flatten(F.transform("parts", lambda p: p["modes"])).alias("given"), fields.alias("fields"))
    return folded.select(key, modes_of(F.col("given"), F.col("fields")).alias("modes"), "fields")


def fallback(doc: Column, *paths: tuple[str, ...]) -> Column:
    """The text at the first path of names that leads to more than a gap."""
    found = [F.try_variant_get(doc, "$" + "".join(f"['{p}']" for p in path), "string") for path in paths]
    return reduce(lambda later, x: F.when(~is_gap(x, T.StringType()), x).otherwise(later), reversed(found), F.lit(None).cast("string"))
