"""Cubes with named categories: documents whose values lie in one dense list, by the categories of several dimensions, and the register that names them.

A document (``ITEM``) lists its dimensions (``id``) with their sizes; a value's place in the list is a number in mixed radix, the last dimension's digit moving fastest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.shapes import ordered_categories
from cairn.operators.validate import violations

CATEGORY = "struct<index: map<string,int>, label: map<string,string>>"
ITEM = f"struct<version: string, class: string, label: string, id: array<string>, size: array<int>, role: map<string,array<string>>, dimension: map<string,struct<label: string, category: {CATEGORY}>>, value: array<double>, status: map<string,string>, extension: map<string,string>>"
#: Dimensions that may occur, and those of which only the number of categories is kept.
DIMENSIONS, COUNTED = ("areacd", "period", "measure", "sex", "age"), ("areacd", "period")
SLUG = "^[a-z0-9]+(?:-[a-z0-9]+)*$"


def digits(sizes: Column, place: Column) -> Column:
    """The place as digits in mixed radix: from each dimension the number of its category. Null if a size isn't positive or the place lies outside."""
    below = lambda i: F.aggregate(F.slice(sizes, i + 2, F.greatest(F.size(sizes) - i - 1, F.lit(0))), F.lit(1).cast("bigint"), lambda a, s: a * s)
    whole = F.aggregate(sizes, F.lit(1).cast("bigint"), lambda a, s: a * s)
    ok = F.forall(sizes, lambda s: s > 0) & (place >= 0) & (place < whole)
    return F.when(ok, F.transform(sizes, lambda s, i: F.try_mod(F.floor(place / below(i)), s.cast("bigint")).cast("int")))


def categories(item: Column) -> Column:
    """For each dimension, in order, its categories by position; null where positions aren't 0 to n - 1."""
    return F.transform(item["id"], lambda d: ordered_categories(F.element_at(item["dimension"], d)["category"]["index"]))


def cells(items: DataFrame, key: str, item: str = "item") -> DataFrame:
    """(key, coordinates, value): every value with the category of each dimension, as a map; nulls are no cells."""
    own = items.select(key, categories(F.col(item)).alias("kinds"), F.col(f"{item}.id").alias("ids"), F.col(f"{item}.size").alias("sizes"), F.col(f"{item}.value").alias("values"))
    # the list is opened in a step of its own: with the nested columns in the same one, Spark's pruning of nested fields fails
    each = own.select(key, "kinds", "ids", "sizes", F.posexplode("values").alias("place", "value")).where("value IS NOT NULL")
    at = each.withColumn("digits", digits(F.col("sizes"), F.col("place").cast("bigint")))
    return at.select(key, F.map_from_arrays("ids", F.zip_with("kinds", "digits", lambda k, i: F.get(k, i))).alias("coordinates"), "value")


def role_of(item: Column, dimension: Column) -> Column:
    """The role that names the dimension; without one a dimension called measure is a measure."""
    named = F.map_keys(F.map_filter(item["role"], lambda _, ids: F.array_contains(ids, dimension)))
    return F.coalesce(F.get(named, F.lit(0)), F.when(dimension == "measure", "measure").otherwise("dimension"))


def dimension_rows(items: DataFrame, key: str, item: str = "item") -> DataFrame:
    """(key, dimension, label, order, role, count, projection, categories): dimensions in order, with the identifiers and labels of all but the large ones."""
    doc = F.col(item)
    own = items.select(key, doc.alias("doc"), F.posexplode(f"{item}.id").alias("order", "dimension"))
    at = F.element_at("doc.dimension", F.col("dimension"))
    named = F.transform(ordered_categories(at["category"]["index"]), lambda c: F.struct(c.alias("id"), F.element_at(at["category"]["label"], c).alias("label")))
    large = F.col("dimension").isin(*COUNTED)
    return own.select(
        key, "dimension", at["label"].alias("label"), "order", role_of(F.col("doc"), F.col("dimension")).alias("role"), F.size(at["category"]["index"]).alias("count"),
        F.when(large, "count-only").otherwise("identifiers-and-labels").alias("projection"), F.when(~large, named).alias("categories"),
    )


def item_faults(items: DataFrame, key: str, item: str = "item", metadata_only: bool = True) -> DataFrame:
    """(key, rule) for documents that aren't of the reviewed shape. A register's documents hold no values (``metadata_only``)."""
    doc = F.col(item)
    ids, sizes, dims = doc["id"], doc["size"], doc["dimension"]
    index = lambda d: F.element_at(dims, d)["category"]["index"]
    rules = {
        "class": (doc["class"] == "dataset") & (doc["version"] == "2.0"),
        "dimension order": (F.size(ids) == F.size(sizes)) & (F.size(F.array_distinct(ids)) == F.size(ids)),
        "unreviewed dimension": F.size(F.array_except(ids, F.array(*map(F.lit, DIMENSIONS)))) == 0,
        "dimension lookup": F.array_sort(F.map_keys(dims)) == F.array_sort(F.array_distinct(ids)),
        "category index": F.forall(F.arrays_zip(ids.alias("id"), sizes.alias("size")), lambda x: F.coalesce(F.size(ordered_categories(index(x["id"]))) == x["size"], F.lit(False))),
        "unknown label": F.forall(F.filter(ids, lambda d: F.map_contains_key(dims, d)), lambda d: F.size(F.array_except(F.coalesce(F.map_keys(F.element_at(dims, d)["category"]["label"]), F.array().cast("array<string>")), F.map_keys(index(d)))) == 0),
        "several roles": F.forall(ids, lambda d: F.size(F.map_filter(doc["role"], lambda _, x: F.array_contains(x, d))) <= 1),
    }
    if metadata_only:
        rules |= {"values": F.size(doc["value"]) == 0, "statuses": doc["status"].isNull()}
    return violations(items, key, rules)


#: Columns of a register that a document's extension repeats.
REPEATED = ("slug", "topic", "subTopic", "dataset", "code")


def register_faults(register: DataFrame) -> DataFrame:
    """(row, rule) for rows (row, slug, topic, subTopic, dataset, code, include): included rows are named and classed, others bare, and no included name occurs twice."""
    word = F.lower(F.trim("include"))
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    times = register.where(word == "true").groupBy("slug").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    rows = register.join(times, "slug", "left")
    rules = {
        "include": word.isin("true", "false"),
        "dataset and code": ~blank("dataset") & ~blank("code"),
        "slug": ~F.coalesce(word == "true", F.lit(False)) | F.coalesce(F.col("slug").rlike(SLUG), F.lit(False)),
        "taxonomy": ~F.coalesce(word == "true", F.lit(False)) | ~blank("topic") & ~blank("subTopic"),
        "excluded but classed": F.coalesce(word != "false", F.lit(True)) | blank("slug") & blank("topic") & blank("subTopic"),
        "slug occurs twice": ~F.coalesce(word == "true", F.lit(False)) | F.col("times").isNull(),
    }
    return violations(rows, "row", rules)


def split_register(register: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Included rows, and the others with the reason why they are left out."""
    included = F.lower(F.trim("include")) == "true"
    out = register.where(~F.coalesce(included, F.lit(False)))
    return register.where(included), out.select(F.concat_ws("::", "dataset", "code").alias("native_id"), "row", F.lit("upstream-manifest-include-false").alias("reason"))


def closure_faults(included: DataFrame, items: DataFrame, item: str = "item") -> DataFrame:
    """(slug, rule): names that only one side has, names of several documents, and columns in which register and document disagree."""
    slug = F.element_at(f"{item}.extension", "slug")
    docs = items.groupBy(slug.alias("slug")).agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct(*(F.element_at(f"{item}.extension", c).alias(c) for c in REPEATED[1:]))).alias("own"))
    rows = included.select("slug", F.struct(*REPEATED[1:]).alias("row")).join(docs, "slug", "full")
    both = F.col("row").isNotNull() & F.col("own").isNotNull()
    rules = {"no document": F.col("docs").isNotNull(), "not in the register": F.col("row").isNotNull(), "several documents": F.coalesce(F.col("docs"), F.lit(1)) == 1}
    rules |= {f"disagree on {c}": ~both | F.col(f"row.{c}").eqNullSafe(F.col(f"own.{c}")) for c in REPEATED[1:]}
    return violations(rows, "slug", rules)


def project_aliases(aliases: DataFrame, published: DataFrame, known_missing: DataFrame) -> DataFrame:
    """(alias, target, outcome) of aliases (alias, target) for published slugs (slug): ``accepted``, ``excluded`` where the missing target is known, else the fault.

    An alias may not name itself or a published slug. Known missing pairs that aren't among the aliases are faults too.
    """
    slugs = published.select(F.col("slug").alias("target")).distinct()
    rows = aliases.join(slugs.withColumn("there", F.lit(True)), "target", "left").join(slugs.select(F.col("target").alias("alias"), F.lit(True).alias("shadows")), "alias", "left")
    rows = rows.join(known_missing.select("alias", F.col("target").alias("known")), "alias", "full")
    outcome = (
        F.when(F.col("target").isNull(), "known missing alias is gone").when(~F.col("alias").rlike(SLUG) | ~F.col("target").rlike(SLUG), "unsafe alias").when(F.col("alias") == F.col("target"), "alias of itself")
        .when(F.col("shadows").isNotNull(), "shadows a published slug").when(F.col("there").isNull() & F.col("known").eqNullSafe(F.col("target")), "excluded").when(F.col("there").isNull(), "unexplained missing target")
        .when(F.col("known").isNotNull(), "known missing target is published").otherwise("accepted")
    )
    return rows.select("alias", F.coalesce("target", "known").alias("target"), outcome.alias("outcome"))
