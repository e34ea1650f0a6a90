"""Search fields, ranking, the inverted index and facets."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.text import BROWSER_PATTERN, SEARCH_STOP_WORDS, evidence_band, fold, search_tokens, shard
from cairn.functions.values import MISSING

#: Weight and mask of each search field.
WEIGHTS = {
    "title": 20, "context": 9, "description": 6, "topics": 6, "statistical": 6, "geography_time": 5, "producers": 5, "record_type": 4, "source": 4, "standards": 3, "identifiers": 3,
}
MASKS = {
    "title": 1, "context": 2, "description": 4, "topics": 8, "record_type": 16, "source": 32, "standards": 64, "identifiers": 128, "statistical": 256, "geography_time": 512, "producers": 1024,
}
#: Limits of the index.
POSTINGS, COMPLETIONS, CHUNK, PREFIX = 5_000, 16, 500, (3, 8)
#: Weights of the browser's ranking, and its bonus where all terms match.
BROWSER_WEIGHTS = {"title": 20, "identifiers": 8, "subjects": 7, "description": 4, "context": 5}
BROWSER_ALL = 15


def joined(*columns: str) -> Column:
    return F.concat_ws(" ", *columns)


def search_fields(columns: Iterable[str] = ()) -> dict[str, Column]:
    """Text of each search field of a record with these columns. Records of lanes have no standards until ``standards.with_standards`` has given them some."""
    own = {"standards": standards_text(F.col("standards"))} if "standards" in columns else {}
    return own | {
        "title": F.col("title"), "context": F.col("context_note"), "description": F.col("notes"), "topics": joined("topics", "tags"),
        "statistical": joined("measure", "unit_of_measure", "frequency", "population_type"), "geography_time": joined("area_served"), "producers": F.col("publisher_title"),
        "record_type": F.col("record_type"), "source": F.col("source_surface"), "identifiers": joined("id", "native_id"),
    }


def standards_text(standards: Column) -> Column:
    """What is searched of a record's standards: names and statuses."""
    return F.array_join(F.transform(standards, lambda s: F.concat_ws(" ", s["standard"], s["status"])), " ")


def query_tokens(text: str) -> list[str]:
    """The search tokenizer for a query, which is ASCII or folded already; the driver needs no Spark job for it."""
    import unicodedata

    plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()
    found = (t.strip("._-") for t in re.findall("[a-z0-9][a-z0-9._-]*", plain))
    return list(dict.fromkeys(t for t in found if len(t) > 1 and t not in SEARCH_STOP_WORDS))


def ranked(records: DataFrame, text: str, limit: int = 10) -> DataFrame:
    """The best records for a query: most distinct terms, then the sum of field weights, then title and id.

    Scoring is one pass without a shuffle, over the records that hold a term's characters at all, and each task keeps its own
    best rows. A query without tokens returns the first records.
    """
    terms = query_tokens(text)
    if not terms:
        return records.withColumns({"matched": F.lit(0), "score": F.lit(0)}).orderBy("source_surface", F.lower("title"), "id").limit(limit)
    wanted = F.array(*map(F.lit, terms))
    hits = {f: F.array_intersect(search_tokens(F.coalesce(c, F.lit(""))), wanted) for f, c in search_fields(records.columns).items()}
    any_term = "|".join(t.replace(".", r"\.") for t in terms)
    rows = records.where(fold(F.concat_ws(" ", *search_fields(records.columns).values())).rlike(any_term)).withColumns({f"_{f}": h for f, h in hits.items()})
    score = sum((F.size(f"_{f}") * WEIGHTS[f] for f in hits), F.lit(0))
    matched = F.size(F.array_distinct(F.concat(*(F.col(f"_{f}") for f in hits))))
    rows = rows.withColumns({"matched": matched, "score": score}).drop(*(f"_{f}" for f in hits))
    return rows.orderBy(F.desc("matched"), F.desc("score"), F.lower("title"), "id").limit(limit).where("matched > 0")


def postings(corpus: DataFrame) -> DataFrame:
    """(token, ordinal, score, mask): weights and masks of the fields of a record that hold a token, each field once.

    The corpus has each record once, so its fields meet in its own row and nothing is shuffled. Tokens of the description, the long field, come first:
    their places tell that it holds them.
    """
    fields = search_fields(corpus.columns)
    names = sorted(fields, key=lambda f: f != "description")
    rows = corpus.select("ordinal", *(search_tokens(F.coalesce(fields[f], F.lit(""))).alias(f"_{f}") for f in names))
    every = F.array_distinct(F.concat(*(f"_{f}" for f in names)))
    each = rows.select("*", F.posexplode(every).alias("_at", "token"))
    holds = {f: F.array_contains(f"_{f}", F.col("token")) for f in names[1:]} | {"description": F.col("_at") < F.size("_description")}
    total = lambda values: reduce(add, (F.when(h, values[f]).otherwise(0) for f, h in holds.items()))
    return each.select("token", "ordinal", total(WEIGHTS).cast("bigint").alias("score"), total(MASKS).alias("mask"))


def tokens_of_records(records: DataFrame) -> DataFrame:
    """(token): a row for each token of each record, whichever fields hold it. Records must be distinct; all fields are one text here, so counts need no grouping by record."""
    text = F.concat_ws(" ", *search_fields(records.columns).values())
    return records.select(F.explode(search_tokens(text)).alias("token"))


def top_postings(rows: DataFrame, limit: int = POSTINGS) -> DataFrame:
    """The best postings of each token. The limit is applied in each task before the shuffle, so a frequent token stays small."""
    best = Window.partitionBy("token").orderBy(F.desc("score"), "ordinal")
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)


def lexicon(rows: DataFrame) -> DataFrame:
    """(token, df, shard) of ``tokens_of_records`` or of postings."""
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).withColumn("shard", shard(F.col("token")))


def completions(words: DataFrame, limit: int = COMPLETIONS) -> DataFrame:
    """(prefix, token, df, rank): the most frequent tokens of each prefix of three to eight characters."""
    low, high = PREFIX
    sizes = F.sequence(F.lit(low), F.least(F.lit(high), F.length("token")))
    each = words.where(F.length("token") >= low).select("token", "df", F.explode(sizes).alias("n"))
    each = each.select(F.left("token", F.col("n")).alias("prefix"), "token", "df")
    best = Window.partitionBy("prefix").orderBy(F.desc("df"), "token")
    return each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)


def facets(score: Column, columns: Iterable[str] = ()) -> dict[str, Column]:
    """List of values of each facet of a record with these columns. Five facets come from columns that not every record has: without them their value is missing."""
    one = lambda c: F.array(F.nullif(F.col(c).cast("string"), F.lit("")))
    yes = lambda c: F.array(F.when(c, "yes").otherwise("no"))
    none = F.array().cast("array<string>")
    own = {c: one(c) if c in columns else none for c in ("subtopic", "geography_vintage", "binding_status")}
    own["derivation_mode"] = F.col("derivation_modes") if "derivation_modes" in columns else none
    own["has_alternatives"] = yes(F.coalesce(F.col("alternative_count") > 0, F.lit(False))) if "alternative_count" in columns else none
    return own | {
        "source_surface": one("source_surface"), "record_type": one("record_type"), "topic": F.col("topics"), "state": one("state"), "frequency": one("frequency"),
        "population_type": one("population_type"), "source_publisher": one("publisher_title"), "unit_of_measure": one("unit_of_measure"), "geography_level": F.col("area_served"),
        "metadata_evidence_band": F.array(evidence_band(score)), "has_methodology": yes(F.size("methodology_links") > 0), "has_quality_documentation": yes(F.size("quality_notes") > 0),
    }


def facet_values(corpus: DataFrame, score: Column) -> DataFrame:
    """(facet, value, ordinal): distinct values; records without one count as missing."""
    own = [F.struct(F.lit(k).alias("facet"), F.array_distinct(F.filter(v, lambda x: x.isNotNull() & (x != ""))).alias("values")) for k, v in facets(score, corpus.columns).items()]
    rows = corpus.select("ordinal", F.explode(F.array(*own)).alias("f"))
    values = F.when(F.size("f.values") > 0, F.col("f.values")).otherwise(F.array(F.lit(MISSING)))
    return rows.select("ordinal", F.col("f.facet").alias("facet"), F.explode(values).alias("value"))


def conjunction(values: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """Ordinals of records that have, for each facet asked for, one of its wanted values. Few rows of each record meet: its matching values."""
    asked = [(F.col("facet") == f) & F.col("value").isin(*v) for f, v in wanted.items()]
    hits = values.where(reduce(or_, asked)).groupBy("ordinal").agg(F.countDistinct("facet").alias("n"))
    return hits.where(F.col("n") == len(wanted)).select("ordinal")


def filter_postings(values: DataFrame, block: int = 10_000) -> DataFrame:
    """(facet, value, block, ordinals): sorted ordinals of each value, in blocks of a bounded range."""
    own = values.withColumn("block", F.floor(F.col("ordinal") / block))
    return own.groupBy("facet", "value", "block").agg(F.sort_array(F.collect_list("ordinal")).alias("ordinals"))


def browser_scored(records: DataFrame, text: str) -> DataFrame:
    """Records with the browser's score: substring matches by field, a bonus for the phrase and one where every term matches."""
    low = text.strip().lower()
    terms = list(dict.fromkeys(re.findall(BROWSER_PATTERN, low)))
    fields = {
        "title": F.col("title"), "identifiers": joined("id", "native_id"), "subjects": joined("topics", "tags"), "description": F.col("notes"), "context": F.col("context_note"),
    }
    if not terms:
        return records.withColumn("score", F.lit(1))
    rows = records.withColumns({f"_{f}": F.lower(F.coalesce(c, F.lit(""))) for f, c in fields.items()})
    rows = rows.withColumns({f"_{f}_{k}": F.col(f"_{f}").contains(t) for f in fields for k, t in enumerate(terms)})  # a text is looked through once for each term
    points = [F.when(F.col(f"_{f}_{k}"), w).otherwise(0) for f, w in BROWSER_WEIGHTS.items() for k in range(len(terms))]
    if len(low) > 2:
        points += [F.when(reduce(and_, (F.col(f"_{f}_{k}") for k in range(len(terms)))) & F.col(f"_{f}").contains(low), 2 * w).otherwise(0) for f, w in BROWSER_WEIGHTS.items()]
    every = reduce(and_, (reduce(or_, (F.col(f"_{f}_{k}") for f in fields)) for k in range(len(terms))))
    points.append(F.when(every, BROWSER_ALL).otherwise(0))
    return rows.withColumn("score", reduce(add, points)).drop(*(c for c in rows.columns if c not in records.columns))
