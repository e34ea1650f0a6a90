"""Checks on schemas themselves, and on assertions that must fit them and have identities of their own."""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators import ledger
from cairn.operators.validate import schema_rules
from cairn.operators.variants import kind_of
from cairn.scratch import materialize

#: Keywords that the validator knows; a schema with another one is refused, so that no rule is passed over in silence.
KEYWORDS = (
    "$defs", "$id", "$ref", "$schema", "additionalProperties", "allOf", "const", "enum", "format", "if", "items", "maximum", "minimum", "minItems", "minLength", "oneOf", "pattern", "properties", "required", "then", "title", "type",
    "uniqueItems",
)
#: Keywords that hold schemas by name, one schema, and a list of schemas.
BY_NAME, SINGLE, LISTED = ("properties", "$defs"), ("items", "if", "then", "additionalProperties"), ("allOf", "oneOf")


def opened(rows: DataFrame, value: str, *keep: Column | str) -> DataFrame:
    """The fields or elements of a column of variants: ``keep``, place, name, inner, kind."""
    inner = rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col(value).outer()).toDF("place", "name", "inner"))
    return inner.select(*keep, "place", "name", "inner", kind_of(F.col("inner")).alias("kind"))


def unknown_keywords(schemas: DataFrame, key: str, schema: str) -> DataFrame:
    """(key, path, keyword) of keywords that aren't known, wherever schemas hold schemas. Names of properties and definitions aren't keywords, nor is what stands in enums and constants."""
    now, found = schemas.select(key, F.lit("$").alias("path"), F.col(schema).alias("here")).where(kind_of(F.col("here")) == "OBJECT"), []
    while True:
        words = materialize(opened(now, "here", key, "path"), "keywords")
        found.append(words.where(~F.col("name").isin(*KEYWORDS)).select(key, "path", F.col("name").alias("keyword")))
        single = words.where(F.col("name").isin(*SINGLE)).select(key, F.concat("path", F.lit("."), "name").alias("path"), F.col("inner").alias("here"), "kind")
        several = words.where((F.col("name").isin(*BY_NAME) & (F.col("kind") == "OBJECT")) | (F.col("name").isin(*LISTED) & (F.col("kind") == "ARRAY")))
        several = several.select(key, F.concat("path", F.lit("."), "name").alias("path"), F.col("inner").alias("several"))
        at = F.when(F.col("name").isNull(), F.concat("path", F.lit("["), F.col("place").cast("string"), F.lit("]"))).otherwise(F.concat("path", F.lit("['"), "name", F.lit("']")))
        each = opened(several, "several", key, "path").select(key, at.alias("path"), F.col("inner").alias("here"), "kind")
        now = single.unionAll(each).where("kind = 'OBJECT'").drop("kind")
        if now.isEmpty():
            return reduce(DataFrame.unionAll, found)


def pinned(schemas: DataFrame, key: str, text: str, digests: dict[str, str]) -> DataFrame:
    """(key, digest, expected) of schemas whose text hasn't the digest that is pinned for them, or for which none is pinned. The list of pins is a parameter."""
    pins = schemas.sparkSession.createDataFrame(list(digests.items()), "pin string, expected string")
    both = schemas.select(F.col(key).cast("string").alias(key), F.sha2(F.col(text), 256).alias("digest")).join(F.broadcast(pins), F.col(key) == F.col("pin"), "left")
    return both.where(~F.col("digest").eqNullSafe(F.col("expected"))).select(key, "digest", "expected")


#: Rules whose outcomes one whole number holds.
RULES = 60


def assertion_faults(assertions: DataFrame, schema: dict[str, Any]) -> DataFrame:
    """(plane, id, rule) of assertions (plane, doc), each a variant with an ``@id``: rules of the schema that they break, and identities that a plane has twice.

    An assertion of several planes may come once, with a list ``planes``: it is judged once. One grouping by identity counts assertions and
    joins what they break, kept as bits; documents themselves are not shuffled.
    """
    rules = schema_rules(schema, F.col("doc"))
    names = [list(rules)[k : k + RULES] for k in range(0, len(rules), RULES)]
    bits = lambda part: reduce(or_bits, (F.when(F.coalesce(rules[name], F.lit(False)), 0).otherwise(1 << k) for k, name in enumerate(part)), F.lit(0).cast("long"))
    plane = F.explode("planes").alias("plane") if "planes" in assertions.columns else F.col("plane")
    judged = assertions.select(plane, F.coalesce(F.try_variant_get("doc", "$['@id']", "string"), F.lit("")).alias("id"), *(bits(part).alias(f"b{k}") for k, part in enumerate(names)))
    own = judged.groupBy("plane", "id").agg(F.count(F.lit(1)).alias("n"), *(F.bit_or(f"b{k}").alias(f"b{k}") for k in range(len(names))))
    wrong = reduce(or_, (F.col(f"b{k}") != 0 for k in range(len(names))), F.col("n") > 1)
    told = [F.when(F.col("n") > 1, "identity occurs twice")]
    told += [F.when(F.col(f"b{k}").bitwiseAND(F.lit(1 << i)) != 0, name) for k, part in enumerate(names) for i, name in enumerate(part)]
    return own.where(wrong).select("plane", "id", F.explode(F.array_compact(F.array(*told))).alias("rule"))


def or_bits(a: Column, b: Column) -> Column:
    return a.bitwiseOR(b)


def identity_sets(assertions: DataFrame) -> DataFrame:
    """(plane, n, digest) of the set of identities of each plane; equal planes have equal rows. As in ``assertion_faults``, an assertion may have a list of planes."""
    if "planes" in assertions.columns:
        assertions = assertions.select(F.explode("planes").alias("plane"), F.try_variant_get("doc", "$['@id']", "string").alias("id"))
        return ledger.set_digest(assertions, "plane", F.coalesce("id", F.lit("")))
    return ledger.set_digest(assertions, "plane", F.coalesce(F.try_variant_get("doc", "$['@id']", "string"), F.lit("")))
