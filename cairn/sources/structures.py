"""What structure definitions say: components with roles and positions, code lists of frequencies and periods, and dimensions of versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.text import plain_text, safe_public_url

#: Roles by kind of component; statuses and words of periods that aren't out yet; labels that name no frequency; concepts whose lists count.
ROLES = {"dimension": "Dimension", "timedimension": "TimeDimension", "attribute": "Attribute", "primarymeasure": "PrimaryMeasure"}
PLACED = ("dimension", "timedimension")
REJECTED = ("future", "not available", "not released", "pre-release", "prerelease", "unreleased")
UNRELEASED = r"(?i)\b(?:not yet released|not released|unreleased)\b"
NO_FREQUENCY = ("n/a", "not applicable", "not available", "unknown")
CONCEPTS = ("FREQ", "TIME")
#: How many dimensions of a version are taken, and how many options one may have.
MOST_DIMENSIONS, MOST_OPTIONS = 100, 100_000_000

COMPONENT = "struct<role: string, concept: string, codeList: string, attachmentLevel: string, assignmentStatus: string, position: int>"
CODELISTS = "array<struct<concept: string, codeList: string, status: string, reason: string, codes: array<struct<value: string, label: string, revisionStatus: string>>>>"


def components(raw: Column) -> Column:
    """Components of known kinds, in order. A dimension's position is the declared one, else its number among the dimensions so far."""
    plain = lambda c, limit: plain_text(F.coalesce(c, F.lit("")), limit)
    roles = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    start = F.struct(F.lit(0).alias("n"), F.array().cast(f"array<{COMPONENT}>").alias("out"))

    def step(acc: Column, c: Column) -> Column:
        kind = F.lower(plain(c["kind"], 100))
        n = acc["n"] + kind.isin(*PLACED).cast("int")
        own = F.struct(
            F.element_at(roles, kind).alias("role"), *(F.nullif(c[x], F.lit("")).alias(x) for x in ("concept", "codeList", "attachmentLevel", "assignmentStatus")), F.when(kind.isin(*PLACED), F.coalesce(c["position"], n)).alias("position")
        ).cast(COMPONENT)
        return F.struct(n.alias("n"), F.when(kind.isin(*ROLES), F.array_append(acc["out"], own)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(F.coalesce(raw, F.array().cast("array<struct<kind: string, concept: string, codeList: string, attachmentLevel: string, assignmentStatus: string, position: int>>")), start, step, lambda acc: acc["out"])


def dimensions_of(own: Column) -> Column:
    return F.filter(own, lambda c: c["position"].isNotNull())


def cleaned(codelists: Column) -> Column:
    """Lists of the known concepts that have a name, with the codes that have a value and a label."""
    text = lambda c, limit: plain_text(F.coalesce(c, F.lit("")), limit)
    codes = lambda x: F.filter(F.transform(x["codes"], lambda c: F.struct(text(c["value"], 300).alias("value"), text(c["label"], 500).alias("label"), text(c["revisionStatus"], 100).alias("revision"))), lambda c: (c["value"] != "") & (c["label"] != ""))
    own = F.transform(codelists, lambda x: F.struct(F.upper(text(x["concept"], 20)).alias("concept"), text(x["codeList"], 300).alias("name"), F.lower(text(x["status"], 100)).alias("status"), text(x["reason"], 200).alias("reason"), codes(x).alias("codes")))
    return F.filter(own, lambda x: x["concept"].isin(*CONCEPTS) & (x["name"] != ""))


def codelist_evidence(rows: DataFrame, codelists: str) -> DataFrame:
    """``rows`` with what their code lists evidence: ``frequency_evidence``, ``time_evidence`` and ``not_evidenced``.

    A frequency is derived from a list of one code alone. Periods count if they are out; coverage is derived where all of them are years, or all are months, and none occurs twice.
    Of several lists of a concept the last counts.
    """
    lists = cleaned(F.col(codelists))
    rows = rows.withColumn("lists", lists)
    last = lambda concept: F.try_element_at(F.filter("lists", lambda x: (x["concept"] == concept) & x["status"].isin("", "present") & (F.size(x["codes"]) > 0)), F.lit(-1))
    rows = rows.withColumns({"freq": last("FREQ"), "time": last("TIME")})
    named = F.filter(F.array_distinct(F.transform("freq.codes", lambda c: c["label"])), lambda x: ~F.lower(x).isin(*NO_FREQUENCY))
    labels = F.transform(F.array_sort(F.transform(named, lambda x: F.struct(F.lower(x).alias("low"), x.alias("label")))), lambda x: x["label"])
    out = F.filter("time.codes", lambda c: ~F.lower(c["revision"]).isin(*REJECTED) & ~c["label"].rlike(UNRELEASED))
    rows = rows.withColumns({"labels": labels, "available": out})
    single = (F.size("freq.codes") == 1) & (F.size("labels") == 1)
    some = F.size("available") > 0
    years = some & F.forall("available", lambda c: c["value"].rlike("^[12][0-9]{3}$"))
    months = some & F.forall("available", lambda c: c["value"].rlike("^[12][0-9]{3}-(0[1-9]|1[0-2])$"))
    rows = rows.withColumn("form", F.when(years, "YYYY").when(months, "YYYY-MM"))
    derived = F.col("form").isNotNull() & (F.size(F.array_distinct(F.transform("available", lambda c: c["value"]))) == F.size("available"))
    ends = F.struct(F.array_min("available").alias("first"), F.array_max("available").alias("last"))
    frequency = F.struct(
        F.col("freq.name").alias("code_list"), F.size("freq.codes").alias("codes"), "labels", F.transform("freq.codes", lambda c: F.struct(c["value"].alias("code"), c["label"].alias("label"))).alias("options"), single.alias("single"),
        F.when(single, F.get("labels", F.lit(0))).alias("frequency"),
    )
    time = F.struct(
        F.col("time.name").alias("code_list"), F.size("time.codes").alias("codes"), F.size("available").alias("available"), F.col("form").alias("period_format"), derived.alias("derived"), F.when(derived, ends["first"]["value"]).alias("start"),
        F.when(derived, ends["last"]["value"]).alias("end"), F.when(derived, ends["first"]["label"]).alias("start_label"), F.when(derived, ends["last"]["label"]).alias("end_label"),
    )
    without = F.transform(F.filter("lists", lambda x: (x["status"] == "not-evidenced") & (x["reason"] != "")), lambda x: F.struct(x["concept"].alias("concept"), x["name"].alias("code_list"), x["reason"].alias("reason")))
    own = rows.withColumns({"frequency_evidence": F.when(F.col("freq").isNotNull(), frequency), "time_evidence": F.when(F.col("time").isNotNull(), time), "not_evidenced": F.coalesce(without, F.array().cast("array<struct<concept: string, code_list: string, reason: string>>"))})
    return own.drop("lists", "freq", "time", "labels", "available", "form")


def version_dimension(d: Column) -> Column:
    """A dimension of a version with plain texts, a public link and a plausible count of options."""
    text = lambda name, limit: F.nullif(plain_text(F.coalesce(d[name], F.lit("")), limit), F.lit(""))
    return F.struct(
        text("id", 300).alias("id"), text("name", 300).alias("name"), text("label", 500).alias("label"), text("description", 5_000).alias("description"), safe_public_url(d["href"]).alias("href"), d["is_area_type"].alias("is_area_type"),
        F.when(d["number_of_options"].between(0, MOST_OPTIONS), d["number_of_options"]).alias("number_of_options"),
    )


def version_dimensions(raw: Column) -> Column:
    """Dimensions of a version, the first hundred at most. Where they come as rows, ``version_dimension`` is worked out before they are put together."""
    return F.transform(F.slice(raw, 1, MOST_DIMENSIONS), version_dimension)


def first_named(own: Column) -> Column:
    """Of dimensions with equal names the first; those without any go. ``own`` should be a column of its own, since it is looked into for every dimension."""
    identity = lambda d: F.concat(*(F.concat(F.coalesce(d[c], F.lit("")), F.lit("\x00")) for c in ("id", "name", "label")))
    names = F.transform(own, identity)
    return F.filter(own, lambda d, i: (identity(d) != "\x00\x00\x00") & (F.array_position(names, identity(d)) == i + 1))


def area_dimensions(own: Column) -> Column:
    """Dimensions that are declared to be areas, or named geography."""
    called = lambda d, c: F.coalesce(F.lower(d[c]) == "geography", F.lit(False))
    return F.filter(own, lambda d: F.coalesce(d["is_area_type"], F.lit(False)) | called(d, "name") | called(d, "label"))


def structure_summary(structures: DataFrame) -> DataFrame:
    """One row over structures (agency, identifier, version, components, complete, query_tool): identities there are, whether every dimension has a position and every component a role, selections and tools."""
    there = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "")
    dimensions = F.filter("components", lambda c: c["role"].isin("Dimension", "TimeDimension"))
    return structures.agg(
        F.count(F.lit(1)).alias("structures"), there("agency").alias("agencies"), there("identifier").alias("identifiers"), there("version").alias("versions"),
        (F.coalesce(F.bool_or(F.size(dimensions) > 0), F.lit(False)) & F.coalesce(F.bool_and(F.forall(dimensions, lambda d: d["position"].isNotNull())), F.lit(True))).alias("order_preserved"),
        (F.coalesce(F.bool_or(F.size("components") > 0), F.lit(False)) & F.coalesce(F.bool_and(F.forall("components", lambda c: F.coalesce(c["role"] != "", F.lit(False)))), F.lit(True))).alias("roles_preserved"),
        F.count_if("complete").alias("complete"), F.count_if(~F.coalesce("complete", F.lit(False))).alias("incomplete"), F.array_sort(F.collect_set(F.nullif("query_tool", F.lit("")))).alias("query_tools"),
    )
