"""Standards that records give evidence for, claims about them, their coverage in answers to queries, and a summary over all records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions.text import canonical_standard
from cairn.functions.values import has_value, ratio
from cairn.operators.evaluation import gain

#: Statuses of a claim, and those that count as covered if there is evidence.
STATUSES, COVERED = ("aligned", "partial", "not-evaluated", "not-applicable"), ("aligned", "partial")
CLAIM = "struct<standard: string, status: string, evidence: string>"


def there(records: DataFrame, name: str) -> Column:
    """Whether a column holds something; false where records have no such column."""
    return F.coalesce(has_value(F.col(name), records.schema[name].dataType), F.lit(False)) if name in records.columns else F.lit(False)


def dimensioned(records: DataFrame) -> Column:
    counted = F.coalesce(F.col("dimension_count") > 0, F.lit(False)) if "dimension_count" in records.columns else F.lit(False)
    return there(records, "dimensions") | counted


def with_standards(records: DataFrame, structure_source: str = "nomis") -> DataFrame:
    """Records with ``standards``: for each of six standards a status and whether the record evidences it. Alignment is claimed, never certification."""
    has = lambda *names: there(records, names[0]) if len(names) == 1 else there(records, names[0]) | has(*names[1:])
    provenance, dimensions = has("provenance"), dimensioned(records)
    quality = has("methodology_links", "quality_links", "quality_notes")
    one = lambda name, status, evidence: F.struct(F.lit(name).alias("standard"), status.alias("status"), evidence.alias("evidence"))
    trust, value = has("metadata_modified") & provenance, has("notes") & has("topics")
    return records.withColumn("standards", F.array(
        one("code-of-practice-3.0", F.lit("partial"), trust | quality | value), one("dcat-3", F.lit("aligned"), has("title") & has("url")), one("dqv", F.lit("partial"), has("quality_evidence")),
        one("prov-o", F.when(provenance, "aligned").otherwise("partial"), provenance), one("sdmx", F.when(F.col("source_surface") == structure_source, "aligned").otherwise("not-applicable"), dimensions),
        one("data-cube", F.when(dimensions, "partial").otherwise("not-evaluated"), dimensions),
    )).withColumn("code_of_practice", F.struct(trust.alias("trustworthiness"), quality.alias("quality"), value.alias("value")))


def with_claims(records: DataFrame, structure_source: str = "nomis") -> DataFrame:
    """Records with ``claims`` of five standards as rankings carry them; evidence is a text, null where there is none."""
    dimensions, own = dimensioned(records), F.col("source_surface") == structure_source
    text = lambda name: F.nullif(F.array_join(name, ",") if records.schema[name].dataType.typeName() == "array" else F.col(name).cast("string"), F.lit("")) if name in records.columns else F.lit(None).cast("string")
    stamp, places, origin = F.coalesce(text("metadata_modified"), text("retrieved_at")), F.coalesce(text("geography"), text("declared_table_codes")), text("provenance")
    one = lambda name, status, evidence: F.struct(F.lit(name).alias("standard"), status.alias("status"), evidence.alias("evidence"))
    known = lambda x, yes: F.when(x.isNotNull(), yes).otherwise("not-evaluated")
    return records.withColumn("claims", F.array(
        one("DCAT-AP", F.lit("partial"), F.concat_ws(" ", "id", "title", "url")), one("SDMX", F.when(own, "aligned").when(dimensions, "partial").otherwise("not-applicable"), F.when(own | dimensions, F.col("source_surface"))),
        one("ISO 8601", known(stamp, "partial"), stamp), one("PROV-O", known(origin, "aligned"), origin), one("GSS geography codes", known(places, "partial"), places),
    ))


def claim_faults(claims: DataFrame, key: str) -> DataFrame:
    """(key, standard, rule) of (key, standard, status, evidence): unknown statuses, evidence that is missing where a status asks for it, and names that are one when written alike."""
    plain = canonical_standard(F.col("standard"))
    twice = claims.groupBy(key, plain.alias("standard")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key, "standard", F.lit("duplicate standard").alias("rule"))
    broken = F.array(F.when(~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)), F.lit("status")), F.when(F.col("status").isin(*COVERED) & ~F.coalesce(has_value(F.col("evidence"), T.StringType()), F.lit(False)), F.lit("evidence")))
    return claims.select(key, plain.alias("standard"), F.explode(F.array_compact(broken)).alias("rule")).unionAll(twice)


SUITE = "query_id string, target string, relevance map<string,int>, alternatives array<struct<id: string, must_expose_by: int, contrast: array<string>>>, evidence array<string>, standards array<string>"
RESULT = f"query_id string, id string, rank int, metadata map<string,string>, contrast map<string,string>, claims array<{CLAIM}>"


def evaluate(suite: DataFrame, results: DataFrame, cutoffs: tuple[int, ...]) -> DataFrame:
    """All measures of each query of a suite: ranks, recall, reciprocal ranks, gain, exposure of alternatives, and coverage of contrasts, evidence and standards.

    A query is judged down to the greatest cutoff or the depth by which its last alternative must appear (``depth``). Queries without results score 0, shares of nothing are 1. Only results that a query
    speaks of are kept, so a query's rows are as few as its judgements, however long rankings are.
    """
    some = F.array().cast("array<string>")
    alternatives = F.coalesce("alternatives", F.array().cast("array<struct<id: string, must_expose_by: int, contrast: array<string>>>"))
    depth = F.greatest(F.lit(max(cutoffs)), F.coalesce(F.array_max(F.transform(alternatives, lambda a: a["must_expose_by"])), F.lit(0)))
    own = suite.select("query_id", "target", F.coalesce("relevance", F.create_map().cast("map<string,int>")).alias("relevance"), alternatives.alias("alternatives"), F.coalesce("evidence", some).alias("evidence"), F.coalesce("standards", some).alias("standards"), depth.alias("depth"))
    asked = own.select("query_id", F.explode(F.array_distinct(F.concat(F.map_keys("relevance"), F.transform("alternatives", lambda a: a["id"]), F.array("target")))).alias("id"))
    hits = results.join(asked, ["query_id", "id"]).groupBy("query_id", "id").agg(F.min(F.struct("rank", F.to_json("metadata").alias("metadata"), F.to_json("contrast").alias("contrast"), "claims")).alias("r"))
    found = hits.groupBy("query_id").agg(F.collect_list(F.struct("id", "r")).alias("hits"))
    rows = own.join(found, "query_id", "left").withColumn("hits", F.coalesce("hits", F.array().cast(found.schema["hits"].dataType)))
    rank_of = lambda i: F.get(F.filter("hits", lambda h: h["id"] == i), F.lit(0))["r"]["rank"]
    grades = F.transform(F.map_entries("relevance"), lambda e: F.struct(e["key"].alias("id"), e["value"].alias("grade"), rank_of(e["key"]).alias("rank")))
    rows = rows.withColumns({"judged": grades, "target_rank": rank_of(F.col("target"))})
    sorted_grades = F.reverse(F.sort_array(F.map_values("relevance")))
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    measures: dict[str, Column] = {}
    for k in cutoffs:
        measures[f"recall_{k}"] = ratio(F.size(F.filter("judged", lambda j: j["rank"] <= k)), F.size("judged"))  # noqa: B023
        dcg = total(F.transform(F.filter("judged", lambda j: j["rank"] <= k), lambda j: gain(j["grade"], j["rank"])))  # noqa: B023
        best = total(F.transform(F.slice(sorted_grades, 1, k), lambda g, i: gain(g, i + 1)))
        measures[f"ndcg_{k}"] = F.when(best > 0, F.round(dcg / best, 6)).otherwise(1.0)
    first = F.array_min(F.filter(F.transform("judged", lambda j: j["rank"]), lambda r: r <= F.col("depth")))
    exposed_target = F.coalesce(F.col("target_rank") <= F.col("depth"), F.lit(False))
    reciprocal = lambda r, ok: F.when(ok, F.round(1 / r, 6)).otherwise(0.0)
    measures |= {"mrr": reciprocal(first, first.isNotNull()), "primary_mrr": reciprocal(F.col("target_rank"), exposed_target)}
    hit_of = lambda i: F.get(F.filter("hits", lambda h: h["id"] == i), F.lit(0))["r"]
    shown = F.transform("alternatives", lambda a: F.struct(a["contrast"].alias("fields"), (F.coalesce(hit_of(a["id"])["rank"] <= a["must_expose_by"], F.lit(False))).alias("exposed"), F.from_json(hit_of(a["id"])["contrast"], "map<string,string>").alias("values")))
    rows = rows.withColumns({"shown": shown, "target_hit": F.when(exposed_target, hit_of(F.col("target")))})
    filled = lambda m, f: F.coalesce(F.trim(F.element_at(m, f)) != "", F.lit(False))
    contrast_present = F.aggregate("shown", F.lit(0), lambda a, s: a + F.when(s["exposed"], F.size(F.filter(s["fields"], lambda f: filled(s["values"], f)))).otherwise(0))
    contrast_wanted = F.aggregate("shown", F.lit(0), lambda a, s: a + F.size(s["fields"]))
    metadata = F.from_json("target_hit.metadata", "map<string,string>")
    claimed = lambda s: F.exists(F.coalesce(F.col("target_hit.claims"), F.array().cast(f"array<{CLAIM}>")), lambda c: (canonical_standard(c["standard"]) == canonical_standard(s)) & c["status"].isin(*COVERED) & F.coalesce(F.trim(c["evidence"]) != "", F.lit(False)))
    rows = rows.withColumns({"evidence_present": F.filter("evidence", lambda f: filled(metadata, f)), "standards_present": F.filter("standards", claimed)})
    measures |= {
        "exposure": ratio(F.size(F.filter("shown", lambda s: s["exposed"])), F.size("shown")), "contrast": ratio(contrast_present, contrast_wanted), "evidence": ratio(F.size("evidence_present"), F.size("evidence")),
        "standards_coverage": ratio(F.size("standards_present"), F.size("standards")),
    }
    missing = {"missing_evidence": F.array_except("evidence", "evidence_present"), "missing_standards": F.array_except("standards", "standards_present")}
    return rows.select("query_id", "depth", "target_rank", *(v.alias(k) for k, v in measures.items()), *(v.alias(k) for k, v in missing.items()))


def availability(records: DataFrame) -> DataFrame:
    """One row: how many records there are, and how many have links to methods, to quality documentation, provenance and dimensions."""
    n = lambda c, name: F.count_if(c).alias(name)
    return records.agg(F.count(F.lit(1)).alias("denominator"), n(there(records, "methodology_links"), "methodology_links"), n(there(records, "quality_links"), "quality_links"), n(there(records, "provenance"), "provenance"), n(dimensioned(records), "dimensions"))


def register_summary(register: DataFrame) -> DataFrame:
    """One row of a register of standards (id, current_as_of, requirements): how many standards and requirements there are, and the latest date."""
    return register.agg(F.count(F.lit(1)).alias("standards"), F.coalesce(F.sum(F.greatest(F.size("requirements"), F.lit(0))), F.lit(0)).alias("requirements"), F.coalesce(F.max(F.nullif("current_as_of", F.lit(""))), F.lit("")).alias("current_as_of"))
