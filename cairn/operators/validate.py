"""Rules on rows, references between tables, forbidden content and dependency graphs."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.scratch import materialize

#: Patterns of content that must not be published, and the library's own one of tokens assigned in text, which comes last.
SECRETS = {
    "key": r"\bsk-(?:proj-)?[A-Za-z0-9_-]{16,}\b",
    "web_token": r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{8,}\b",
    "authorization": r"(?i)\b(?:authorization|api[-_ ]?key|access[-_ ]?token)\s*[:=]\s*[\"']?[A-Za-z0-9._~+/-]{12,}",
    "local_path": r"(?:/Users/|/Volumes/|/private/tmp/|/tmp/)[^\s\"']+",
    "assignment": r"(?i)\b(?:token|password)\s*=\s*\"?[A-Za-z0-9]{8,}",
}


#: Names of fields that must not be published.
PRIVATE_FIELDS = ("analysis", "chain_of_thought", "chainofthought", "hidden_reasoning", "private_reasoning", "raw_chain_of_thought")


def unpublishable(names: Column, text: Column) -> Column:
    """Why an artefact can't be published: private field names, compared in lower case with underscores for hyphens, and the fixed kinds of forbidden content."""
    plain = F.transform(names, lambda n: F.replace(F.lower(F.trim(n)), F.lit("-"), F.lit("_")))
    private = F.transform(F.array_intersect(plain, F.array(*map(F.lit, PRIVATE_FIELDS))), lambda n: F.concat(F.lit("name:"), n))
    kinds = F.filter(F.array(*(F.when(text.rlike(p), F.lit(f"text:{k}")) for k, p in SECRETS.items() if k != "assignment")), F.isnotnull)
    return F.array_sort(F.concat(private, kinds))


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule): rules, true where a row is right, that a row breaks; null counts as broken."""
    broken = F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())), F.isnotnull)
    return rows.select(key, F.explode(broken).alias("rule"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows whose reference no parent has."""
    keys = parent.select(F.col(parent_key).alias("_key")).distinct()
    return child.where(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_key"), "left_anti")


def secret_kinds(text: Column) -> Column:
    """Names of the forbidden patterns in a text."""
    return F.filter(F.array(*(F.when(text.rlike(p), F.lit(k)) for k, p in SECRETS.items())), F.isnotnull)


#: Kinds of variants that each type of a schema takes.
KINDS = {
    "string": ("STRING",), "integer": ("BIGINT", "INT"), "number": ("BIGINT", "INT", "DOUBLE", "DECIMAL", "FLOAT"), "boolean": ("BOOLEAN",), "object": ("OBJECT",), "array": ("ARRAY",), "null": ("VOID",),
}
FORMATS = {
    "uri": lambda x: x.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:\S*$"),
    "date-time": lambda x: x.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:\d{2})$") & F.try_to_timestamp(x).isNotNull(),
}


def schema_rules(schema: dict[str, Any], value: Column, path: str = "$", root: dict[str, Any] | None = None) -> dict[str, Column]:
    """Rules for a variant column from a subset of JSON Schema: type, const, enum, oneOf, allOf, if and then, required, properties,
    additionalProperties, minItems, uniqueItems, items, minLength, pattern, format, minimum, maximum and local references.

    Nested schemas are unrolled here, so the result is a flat set of built-in expressions. A value of another type than the schema's
    breaks that rule alone, and a rule holds for values that it doesn't speak of: a least length for numbers, say.
    """
    root = root or schema
    if "$ref" in schema:
        target: Any = root
        for part in schema["$ref"].removeprefix("#/").split("/"):
            target = target[part]
        return schema_rules(target, value, path, root)
    here, text = F.try_variant_get(value, path, "variant"), F.try_variant_get(value, path, "string")
    kind = F.regexp_extract(F.schema_of_variant(here), "^[A-Z]+", 0)
    is_a = lambda name: F.coalesce(kind.isin(*KINDS[name]), F.lit(False))
    there, rules = here.isNotNull(), {}
    if "type" in schema:
        rules["type"] = is_a(schema["type"])
    if "const" in schema:
        rules["const"] = F.coalesce(text == constant(schema["const"]), F.lit(False))
    if "enum" in schema:
        rules["enum"] = F.coalesce(text.isin(*map(constant, schema["enum"])), F.lit(False))
    if "minLength" in schema:
        rules["minLength"] = ~is_a("string") | (F.length(text) >= schema["minLength"])
    if "pattern" in schema:
        rules["pattern"] = ~is_a("string") | text.rlike(schema["pattern"])
    if "format" in schema:
        rules["format"] = ~is_a("string") | FORMATS[schema["format"]](text)
    number = F.try_variant_get(value, path, "double")
    if "minimum" in schema:
        rules["minimum"] = ~is_a("number") | (number >= schema["minimum"])
    if "maximum" in schema:
        rules["maximum"] = ~is_a("number") | (number <= schema["maximum"])
    items = F.try_variant_get(value, path, "array<variant>")
    if "minItems" in schema:
        rules["minItems"] = ~is_a("array") | (F.size(items) >= schema["minItems"])
    if schema.get("uniqueItems"):
        texts = F.transform(items, lambda x: F.to_json(x))
        rules["uniqueItems"] = ~is_a("array") | (F.size(F.array_distinct(texts)) == F.size(texts))
    if "items" in schema:
        rules["items"] = ~is_a("array") | F.forall(items, lambda x: fits(schema["items"], x, "$", root))
    if "oneOf" in schema:
        rules["oneOf"] = sum((fits(s, value, path, root).cast("int") for s in schema["oneOf"]), F.lit(0)) == 1
    if "if" in schema and "then" in schema:
        rules["then"] = ~fits(schema["if"], value, path, root) | fits(schema["then"], value, path, root)
    for name in schema.get("required", []):
        rules[f"required {name}"] = ~is_a("object") | F.try_variant_get(value, f"{path}.{name}", "variant").isNotNull()
    if schema.get("additionalProperties") is False:
        names = F.map_keys(F.try_variant_get(value, path, "map<string,variant>"))
        rules["additionalProperties"] = ~is_a("object") | (F.size(F.array_except(names, F.array(*map(F.lit, schema.get("properties", {}))))) == 0)
    out = {f"{path}:{name}": ~there | F.coalesce(ok, F.lit(False)) for name, ok in rules.items()}
    if "type" in schema:  # nothing else is said of a value of another type
        out = {name: ok if name == f"{path}:type" else ~is_a(schema["type"]) | ok for name, ok in out.items()}
    for part in schema.get("allOf", []):
        out |= schema_rules(part, value, path, root)
    for name, inner in schema.get("properties", {}).items():
        out |= schema_rules(inner, value, f"{path}.{name}", root)
    return out


def constant(x: object) -> str:
    """A constant as a variant's text."""
    return str(x).lower() if isinstance(x, bool) else str(x)


def fits(schema: dict[str, Any], value: Column, path: str = "$", root: dict[str, Any] | None = None) -> Column:
    """Whether a value breaks no rule of a schema."""
    return reduce(and_, schema_rules(schema, value, path, root).values(), F.lit(True))


def reachable(edges: DataFrame) -> DataFrame:
    """(node, needs): everything that each node depends on, directly or not. A node that needs itself lies on a cycle.

    Paths double in each round, so a chain of n takes about log2 n rounds, and cycles end like all else: when nothing new comes.
    """
    known = materialize(edges.select("node", "needs").distinct(), "reach")
    n, before = known.count(), -1
    while n != before:
        further = known.alias("a").join(known.alias("b"), F.col("a.needs") == F.col("b.node")).select("a.node", "b.needs")
        known = materialize(known.unionAll(further).distinct(), "reach")
        n, before = known.count(), n
    return known
