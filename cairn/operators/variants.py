"""Walks through nested documents of unknown shape, level by level.

A step opens the containers of one level, so a walk takes as many jobs as documents are deep, and each is a plain scan: no document is ever put together in
one place. Objects' fields come in the order of their names, as variants keep them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.scratch import materialize

NUMBERS = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "DECIMAL")


def kind_of(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT and so on; null for none."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def levels(rows: DataFrame, key: str, doc: str, into: Column | None = None, depth: int | None = None) -> list[DataFrame]:
    """Nodes by depth, from the documents themselves: (key, at, name, kind, value), ``at`` being the places on the way down.

    ``into`` says of nodes whether they are opened, and ``depth`` how many steps are made at most; else a walk ends where no container is left.
    """
    spark = rows.sparkSession
    step = [rows.select(key, F.array().cast("array<int>").alias("at"), F.lit(None).cast("string").alias("name"), kind_of(F.col(doc)).alias("kind"), F.col(doc).alias("value"))]
    while depth is None or len(step) <= depth:
        opened = step[-1].where(F.col("kind").isin("OBJECT", "ARRAY") & (F.lit(True) if into is None else into)).select(key, "at", "value")
        inner = opened.lateralJoin(spark.tvf.variant_explode(F.col("value").outer()).toDF("place", "name", "inner"))
        below = materialize(inner.select(key, F.array_append("at", F.col("place")).alias("at"), "name", kind_of(F.col("inner")).alias("kind"), F.col("inner").alias("value")), "level")
        if below.isEmpty():
            break
        step.append(below)
    return step


def walk(rows: DataFrame, key: str, doc: str, into: Column | None = None, depth: int | None = None) -> DataFrame:
    """All nodes below the documents, as (key, depth, at, name, kind, value)."""
    found = levels(rows, key, doc, into, depth)
    below = [x.withColumn("depth", F.lit(d)) for d, x in enumerate(found) if d] or [found[0].withColumn("depth", F.lit(0)).limit(0)]
    return reduce(DataFrame.unionAll, below).select(key, "depth", "at", "name", "kind", "value")


def as_number(value: Column, kind: Column) -> Column:
    """The number that a number or a text of digits stands for; null for all else, infinities included."""
    text = F.regexp_replace(F.try_variant_get(value, "$", "string"), r"^\s+|\s+$", "")
    based = F.coalesce(*(F.when(text.rlike(f"^0[{mark}{mark.upper()}][{digits}]+$"), F.conv(F.substring(text, 3, 64), base, 10).cast("double")) for mark, digits, base in (("x", "0-9A-Fa-f", 16), ("o", "0-7", 8), ("b", "01", 2))))
    written = F.when(text.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"), text.try_cast("double"))
    number = F.when(kind.isin(*NUMBERS), F.try_variant_get(value, "$", "double")).when(kind == "STRING", F.coalesce(based, written))
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def first_number(rows: DataFrame, key: str, doc: str, wanted: tuple[str, ...], depth: int = 5) -> DataFrame:
    """(key, number): of fields with one of the names the first that is a number, nearest to the top, then in order; null where there is none.

    Names are compared in lower case with underscores for hyphens. Containers ``depth`` steps below the document are still opened.
    """
    named = F.lower(F.replace("name", F.lit("-"), F.lit("_"))).isin(*(w.lower() for w in wanted))
    hits = walk(rows, key, doc, depth=depth + 1).where(named).select(key, F.struct("depth", "at").alias("place"), as_number(F.col("value"), F.col("kind")).alias("number")).where("number IS NOT NULL")
    first = hits.groupBy(key).agg(F.min_by("number", "place").alias("number"))
    return rows.select(key).distinct().join(first, key, "left")


def number_at(doc: Column, path: tuple[str, ...]) -> Column:
    """The number at a path of names, or null."""
    here = F.try_variant_get(doc, "$" + "".join(f"['{p}']" for p in path), "variant")
    return as_number(here, kind_of(here))


def collection_in(value: Column, names: tuple[str, ...]) -> Column:
    """The array under the first of the names that has one."""
    own = [F.try_variant_get(value, f"$['{n}']", "variant") for n in names]
    return F.coalesce(*(F.when(kind_of(x) == "ARRAY", x) for x in own))


def first_collection(rows: DataFrame, key: str, doc: str, names: tuple[str, ...]) -> DataFrame:
    """(key, items): the array under one of the names: the document's own, else the first non-empty one further down, objects being entered in their order.

    An object with such an array is not entered, even if the array is empty.
    """
    found = levels(rows, key, doc, into=(F.col("kind") == "OBJECT") & collection_in(F.col("value"), names).isNull())
    hits = [x.where("kind = 'OBJECT'").select(key, "at", collection_in(F.col("value"), names).alias("items"), F.lit(d).alias("depth")) for d, x in enumerate(found)]
    some = reduce(DataFrame.unionAll, hits).withColumn("items", F.try_variant_get("items", "$", "array<variant>")).where("items IS NOT NULL AND (depth = 0 OR size(items) > 0)")
    first = some.groupBy(key).agg(F.min_by("items", "at").alias("items"))
    return rows.select(key).distinct().join(first, key, "left").withColumn("items", F.coalesce("items", F.array().cast("array<variant>")))


def numeric_points(rows: DataFrame, key: str, doc: str) -> DataFrame:
    """(key, at, x, y): pairs of numbers at any depth of nested lists. A list that begins with two numbers is a point and isn't entered; infinite ones don't count."""
    first, second = (F.try_variant_get("value", f"$[{i}]", "variant") for i in (0, 1))
    pair = F.coalesce(kind_of(first).isin(*NUMBERS) & kind_of(second).isin(*NUMBERS), F.lit(False))
    nodes = levels(rows, key, doc, into=(F.col("kind") == "ARRAY") & ~pair)
    lists = reduce(DataFrame.unionAll, nodes).where((F.col("kind") == "ARRAY") & pair)
    points = lists.select(key, "at", F.try_variant_get("value", "$[0]", "double").alias("x"), F.try_variant_get("value", "$[1]", "double").alias("y"))
    return points.where(~F.isnan("x") & ~F.isnan("y") & (F.abs("x") != float("inf")) & (F.abs("y") != float("inf")))


def points_extent(points: DataFrame, key: str) -> DataFrame:
    """(key, west, south, east, north) of documents whose points all lie on the globe."""
    box = points.groupBy(key).agg(F.min("x").alias("west"), F.min("y").alias("south"), F.max("x").alias("east"), F.max("y").alias("north"))
    return box.where("west >= -180 AND east <= 180 AND south >= -90 AND north <= 90")


def canonical_text(rows: DataFrame, key: str, doc: str) -> DataFrame:
    """(key, text): JSON with the fields of every object ordered by name without regard to case. Put together from the deepest level upwards."""
    found = levels(rows, key, doc)
    inner: DataFrame | None = None
    for level in reversed(found):
        own = level.join(inner.hint("merge"), [key, "at"], "left") if inner is not None else level.withColumns({"parts": F.lit(None).cast("array<string>")})
        listed = F.coalesce(F.array_join("parts", ","), F.lit(""))
        text = F.when(F.col("kind") == "OBJECT", F.concat(F.lit("{"), listed, F.lit("}"))).when(F.col("kind") == "ARRAY", F.concat(F.lit("["), listed, F.lit("]"))).otherwise(F.to_json("value"))
        texts = own.select(key, "at", "name", text.alias("text"))
        name = F.to_json(F.array("name"))  # a name as JSON: the one element of a list, without the brackets
        part = F.when(F.col("name").isNull(), F.col("text")).otherwise(F.concat(F.substr(name, F.lit(2), F.length(name) - 2), F.lit(":"), "text"))
        entry = F.struct(F.lower("name").alias("low"), F.element_at("at", -1).alias("place"), part.alias("part"))
        inner = texts.groupBy(key, F.slice("at", 1, F.greatest(F.size("at") - 1, F.lit(0))).alias("at")).agg(F.transform(F.sort_array(F.collect_list(entry)), lambda x: x["part"]).alias("parts"))
    return texts.select(key, "text")
