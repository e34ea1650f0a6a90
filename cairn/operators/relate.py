"""Relationships of records: alternatives, contrasts, reconciliation across sources and triples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.text import similarity_tokens, table_title
from cairn.operators.profiles import nearest
from cairn.scratch import broadcast_if, materialize
from cairn.sources.records import with_ordinal

#: Fixed values of the similarity: records that share tokens held by more records alone are held against each other by profiles; shares of title and all tokens; threshold; how many stay.
FREQUENT, TITLE_SHARE, ALL_SHARE, THRESHOLD, ALTERNATIVES = 500, 0.75, 0.25, 0.32, 4
#: Words of 64 bits in a record's signature.
SIGNATURE = 8
#: Predicate, assertion status and rule of each kind of relationship.
KINDS = {
    "alternative": ("vocab/discoveryAlternative", "inferred", "rules/deterministic-title-topic-similarity-v1"),
    "cross-source-alternative": ("vocab/crossSourceDiscoveryAlternative", "inferred", "rules/deterministic-title-topic-similarity-v1"),
    "cross-source-representation": ("vocab/crossSourceRepresentation", "normalized", "rules/shared-declared-table-code-v1"),
}
#: Names of the fields in which two records are held against each other, with the columns that they come from.
CONTRASTS = {
    "source surface": "source_surface", "record type": "record_type", "dataset family": "dataset_family", "topic": "topics", "measure": "measure", "unit": "unit_of_measure", "frequency": "frequency",
    "population": "population_type", "geography": "area_served", "geography vintage": "geography_vintage", "time coverage": "time_coverage", "source producers": "publisher_title", "edition": "latest_edition",
    "version": "latest_version", "release state": "state", "last updated": "metadata_modified", "methodology evidence": "methodology_links", "quality documentation": "quality_links",
}
#: Of these lists only whether they hold anything counts.
EVIDENCED = ("methodology_links", "quality_links")


def tokenised(records: DataFrame) -> DataFrame:
    """Records with their distinct tokens of the title and of title, topics and tags."""
    everything = F.concat_ws(" ", "title", F.array_join("topics", " "), F.array_join("tags", " "))
    return records.withColumns({"title_tokens": F.array_distinct(similarity_tokens(F.coalesce("title", F.lit("")))), "all_tokens": F.array_distinct(similarity_tokens(everything))})


def overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two distinct lists, 0 if both are empty."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union > 0, common / union).otherwise(F.lit(0.0))


def signed(own: DataFrame) -> DataFrame:
    """Postings (token, id, sizes, signature) of all tokens: each token of a record flips one of the ``SIGNATURE`` words' bits."""
    bits = F.transform("all_tokens", lambda t: F.xxhash64(t))
    flip = lambda k: F.aggregate(bits, F.lit(0).cast("long"), lambda a, h: F.when(F.pmod(F.shiftrightunsigned(h, 6), F.lit(SIGNATURE)) == k, a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int")))).otherwise(a))
    slim = own.select("id", F.size("title_tokens").alias("t"), F.size("all_tokens").alias("n"), *(flip(k).alias(f"s{k}") for k in range(SIGNATURE)), "all_tokens")
    return slim.select(F.explode("all_tokens").alias("token"), *slim.columns[:-1])


def may_reach(threshold: float) -> Column:
    """Whether postings ``a`` and ``b`` can score ``threshold``: bits that differ are no more than tokens that differ, which bounds the tokens in common."""
    differ = sum((F.bit_count(F.col(f"a.s{k}").bitwiseXOR(F.col(f"b.s{k}"))) for k in range(1, SIGNATURE)), F.bit_count(F.col("a.s0").bitwiseXOR(F.col("b.s0"))))
    common = (F.col("a.n") + F.col("b.n") - differ) / 2
    bound = lambda c: (lambda most: most / F.greatest(F.col(f"a.{c}") + F.col(f"b.{c}") - most, F.lit(1)))(F.least(common, F.col(f"a.{c}"), F.col(f"b.{c}")))
    return F.lit(TITLE_SHARE) * bound("t") + F.lit(ALL_SHARE) * bound("n") >= threshold - 1e-9


def by_profiles(own: DataFrame, frequent: DataFrame, limit: int, threshold: float) -> DataFrame:
    """(id, other, title, r, q, score, same): for each record the first others by what they share of ``frequent`` tokens (token, df), more than ``limit`` where ids are repeated.

    A score is what two records that share no other token have, and less than others have. So whoever is among the ``limit`` best of a record and shares nothing else with it is among
    these: what stands before it here stands before it there. Records that can't reach the threshold by these tokens are left out.
    """
    each = own.select("r", F.size("t").alias("n_title"), F.size("a").alias("n_all"), F.explode("a").alias("token"), F.col("t").alias("words"))
    each = each.join(broadcast_if(frequent, 200_000, cheap=True), "token").withColumn("titled", F.array_contains("words", F.col("token")))
    some = lambda c: F.sort_array(F.collect_list(F.when(c, F.col("token"))))
    sets = each.groupBy("r", "n_title", "n_all").agg(some(F.col("titled")).alias("title_"), some(~F.col("titled")).alias("other_"), F.max_by("token", F.struct("df", "token")).alias("lead"))
    share = lambda k, n: k / F.greatest(F.col(n), F.lit(1))
    most = F.lit(TITLE_SHARE) * share(F.size("title_"), "n_title") + F.lit(ALL_SHARE) * share(F.size("title_") + F.size("other_"), "n_all")
    key = F.md5(F.concat_ws("|", "n_title", "n_all", F.array_join(F.col("title_").cast("array<string>"), ","), F.array_join(F.col("other_").cast("array<string>"), ",")).cast("binary"))
    able = sets.where(most >= threshold - 1e-9).withColumn("key", key).join(own.select("r", "id", "title", "source_surface"), "r")
    able = with_ordinal(able, F.col("title"), F.col("id"), name="place")
    reps, times = able, able.groupBy("id").count().agg(F.max("count")).first()[0] or 1
    if times > 1:  # of one id no more than the limit can be wanted in a profile
        reps = materialize(able.withColumn("nth", F.row_number().over(Window.partitionBy("key", "id").orderBy("place"))).where(F.col("nth") <= limit), "repeated")
        times = reps.groupBy("id").count().agg(F.max("count")).first()[0]
    n = limit + times  # a record's own id is left out afterwards
    first = reps.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("place"))).where(F.col("nth") <= n)
    whole = (F.any_value(c).alias(a) for c, a in (("lead", "lead"), ("title_", "title"), ("other_", "other"), ("n_title", "n_title"), ("n_all", "n_all")))
    profiles = materialize(first.groupBy("key").agg(*whole, F.sort_array(F.collect_list("place")).alias("places")), "profiles")
    best = materialize(nearest(profiles, n, (TITLE_SHARE, ALL_SHARE), threshold), "nearest")
    told = best.join(able.select("place", F.col("id").alias("other"), "title", F.col("r").alias("q"), F.col("source_surface").alias("theirs")), "place")
    both = told.join(able.select("key", "id", "r", "source_surface"), "key").where(F.col("id") != F.col("other"))
    return both.select("id", "other", "title", "r", "q", "score", (F.col("source_surface") == F.col("theirs")).alias("same"))


def alternatives(records: DataFrame, limit: int = ALTERNATIVES, threshold: float = THRESHOLD) -> DataFrame:
    """(id, other, rank, similarity, shared, kind): the most similar other records of each record, of all that share a token.

    Records that share a token that few records hold meet by it, so a token makes at most FREQUENT squared pairs. Of these only pairs go on whose
    signatures leave the threshold within reach; scores use all tokens, by 64-bit hashes. Those that share frequent tokens alone come from ``by_profiles``, whose score for a pair that
    met already is lower than its own, so of two rows of a pair the better counts. The tokens themselves are read again for the rows that stay.
    """
    hashed = lambda c: F.transform(c, lambda t: F.xxhash64(t))
    own = tokenised(records).select(F.monotonically_increasing_id().alias("r"), "id", "title", "source_surface", hashed("title_tokens").alias("t"), hashed("all_tokens").alias("a"), "title_tokens", "all_tokens")
    own = materialize(own, "tokenised")
    held = own.select(F.explode("all_tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    rare = held.where(F.col("df").between(2, FREQUENT)).select("token")
    frequent = materialize(held.where(F.col("df") > FREQUENT).select(F.xxhash64("token").alias("token"), "df"), "frequent")
    tasks = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes make many pairs, so tasks aren't dealt by bytes
    each = signed(own).repartition(tasks, "token").join(rare, "token")  # dealt before they meet: behind the join it would be left out
    pairs = each.alias("a").join(each.alias("b").hint("merge"), "token").where(F.col("a.id") < F.col("b.id")).where(may_reach(threshold))
    pairs = pairs.select(F.col("a.id").alias("id"), F.col("b.id").alias("other")).repartition(tasks, "id").distinct()
    slim = lambda id, n: own.select(F.col("id").alias(id), F.col("title").alias(f"l{n}"), F.col("t").alias(f"t{n}"), F.col("a").alias(f"a{n}"), F.col("source_surface").alias(f"s{n}"), F.col("r").alias(f"r{n}")).repartition(tasks, id)
    common = pairs.join(slim("id", 1), "id").repartition(tasks, "other").join(slim("other", 2), "other")
    score = F.lit(TITLE_SHARE) * overlap(F.col("t1"), F.col("t2")) + F.lit(ALL_SHARE) * overlap(F.col("a1"), F.col("a2"))
    one = common.select("id", "other", "l1", "l2", "r1", "r2", score.alias("score"), (F.col("s1") == F.col("s2")).alias("same"))
    side = lambda id, other, title, r, q: F.struct(F.col(id).alias("id"), F.col(other).alias("other"), F.col(title).alias("title"), F.col(r).alias("r"), F.col(q).alias("q"))
    both = one.select("score", "same", F.explode(F.array(side("id", "other", "l2", "r1", "r2"), side("other", "id", "l1", "r2", "r1"))).alias("p")).where(F.col("score") >= threshold).select("p.*", "score", "same")
    best = Window.partitionBy("id").orderBy(F.desc("score"), "title", "other")
    if not frequent.isEmpty():
        both = both.unionByName(by_profiles(own, frequent, limit, threshold))
        # a pair's second row stands behind its better one, so twice the limit holds the best
        both = both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= 2 * limit)
        both = both.withColumn("again", F.row_number().over(Window.partitionBy("id", "r", "q").orderBy(F.desc("score")))).where("again = 1").drop("rank", "again")
    top = both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
    kind = F.when(F.col("same"), "alternative").otherwise("cross-source-alternative")
    full = lambda r, c: own.select(F.col("r").alias(r), F.col("all_tokens").alias(c))
    shared = F.slice(F.array_sort(F.array_intersect("w", "v")), 1, 12)
    told = top.join(full("r", "w"), "r").join(full("q", "v"), "q")
    return told.select("id", "other", "rank", F.round("score", 3).alias("similarity"), shared.alias("shared"), kind.alias("kind"))


def context_notes(found: DataFrame, records: DataFrame) -> DataFrame:
    """(id, context_note): the titles of a record's first three alternatives."""
    titled = found.where("rank <= 3").join(records.select(F.col("id").alias("other"), "title"), "other")
    titles = F.transform(F.sort_array(F.collect_list(F.struct("rank", "title"))), lambda x: x["title"])
    notes = titled.groupBy("id").agg(F.concat(F.lit("Compare before selecting: "), F.array_join(titles, "; "), F.lit(".")).alias("context_note"))
    none = F.lit("No close alternative was identified from available metadata.")
    return records.select("id").join(notes, "id", "left").select("id", F.coalesce("context_note", none).alias("context_note"))


def contrast_text(records: DataFrame, name: str) -> Column:
    """A column as text: lists joined, of evidence whether there is any. A subtopic goes before the topics; a column that records lack is empty."""
    if name == "topics" and "subtopic" in records.columns:
        return F.coalesce(F.nullif("subtopic", F.lit("")), F.array_join("topics", ","))
    if name in EVIDENCED:
        return (F.size(name) > 0).cast("string") if name in records.columns else F.lit("false")
    if name not in records.columns:
        return F.lit("")
    return F.array_join(name, ",") if records.schema[name].dataType.typeName() == "array" else F.col(name).cast("string")


def contrasts(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """(id, other, field, selected, alternative): fields whose values differ, one of them at least present."""
    values = F.array(*(F.struct(F.lit(k).alias("field"), F.coalesce(contrast_text(records, v), F.lit("")).alias("value")) for k, v in CONTRASTS.items()))
    own = records.select("id", values.alias("v"))
    both = pairs.select("id", "other").join(own, "id").join(own.select(F.col("id").alias("other"), F.col("v").alias("w")), "other")
    rows = both.select("id", "other", F.explode(F.zip_with("v", "w", lambda a, b: F.struct(a["field"].alias("field"), a["value"].alias("selected"), b["value"].alias("alternative")))).alias("d"))
    return rows.select("id", "other", "d.*").where("selected <> alternative")


def reconcile(records: DataFrame, anchor: Column) -> DataFrame:
    """One row per declared code with an anchor: status, the anchor and the candidate chosen.

    Several anchors, or several candidates of which not exactly one has the anchor's title, are conflicts. Only counts and
    least ids are kept for a code, so one that very many records declare makes no large group.
    """
    own = records.where("declared_code IS NOT NULL").select(F.col("declared_code").alias("code"), "id", "title", anchor.alias("anchor"), table_title(F.col("title")).alias("words"))
    anchors = own.where("anchor").groupBy("code").agg(F.count(F.lit(1)).alias("anchors"), F.min(F.struct("id", "title", "words")).alias("a"))
    others = own.where("NOT anchor").join(anchors.select("code", F.col("a.words").alias("wanted")), "code")
    same = F.col("words") == F.col("wanted")
    counts = others.groupBy("code").agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(same).alias("titled"), F.min(F.struct("id", "title")).alias("any"), F.min(F.when(same, F.struct("id", "title"))).alias("match")
    )
    both = anchors.join(counts, "code", "left").withColumn("n", F.coalesce("candidates", F.lit(0)))
    status = (
        F.when(F.col("anchors") > 1, "ambiguous-anchor-source").when(F.col("n") == 0, "unmatched").when(F.col("titled") == 1, "normalised-identical")
        .when(F.col("n") == 1, "conflicted").otherwise("ambiguous-cross-source-candidates")
    )
    both = both.withColumn("status", status)
    matched = F.col("status").isin("normalised-identical", "conflicted")
    chosen = F.when(matched, F.when(F.col("titled") == 1, F.col("match.id")).otherwise(F.col("any.id")))
    return both.select("code", "status", F.when(F.col("anchors") == 1, F.col("a.id")).alias("anchor_id"), chosen.alias("candidate_id"), "anchors", F.col("n").alias("candidates"))


def assertion_id(source: Column, predicate: Column, target: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.concat(F.lit("record/"), source), predicate, F.concat(F.lit("record/"), target)), 256)


def triples(edges: DataFrame) -> DataFrame:
    """(subject, predicate, object, status, rule, assertion_id) of (source, target, kind) edges."""
    kinds = edges.sparkSession.createDataFrame([(k, *v) for k, v in KINDS.items()], "kind string, predicate string, status string, rule string")
    own = edges.join(F.broadcast(kinds), "kind")
    subject, object_ = F.concat(F.lit("record/"), "source"), F.concat(F.lit("record/"), "target")
    return own.select(subject.alias("subject"), "predicate", object_.alias("object"), "status", "rule", assertion_id(F.col("source"), F.col("predicate"), F.col("target")).alias("assertion_id"))


#: Provenance fields that may tell when evidence was seen, in order, and what is said where none does.
SEEN = ("retrieved_at", "source_commit_as_of", "source_as_of")
NOT_SEEN = "bundle-publication-generated-at; source retrieval not evidenced"


def evidence_time(provenance: str, generated_at: str) -> tuple[Column, Column]:
    """When evidence was seen and the field that says so, from a map of provenance; else when the bundle was made."""
    fields = [F.nullif(F.trim(F.try_element_at(provenance, F.lit(f))), F.lit("")) for f in SEEN]
    basis = F.coalesce(*(F.when(f.isNotNull(), f"provenance.{name}") for f, name in zip(fields, SEEN, strict=True)), F.lit(NOT_SEEN))
    return F.coalesce(*fields, F.lit(generated_at)), basis


def unregistered(edges: DataFrame, records: DataFrame) -> DataFrame:
    """(source, target, kind) of edges without both endpoints or of an unknown kind; none may remain."""
    keys = records.select(F.col("id").alias("key"))
    missing = edges.join(keys, edges["source"] == F.col("key"), "left_anti").unionAll(edges.join(keys, edges["target"] == F.col("key"), "left_anti"))
    return missing.unionAll(edges.where(~F.col("kind").isin(*KINDS))).select("source", "target", "kind").distinct()


def compiled(edges: DataFrame, records: DataFrame, generated_at: str) -> DataFrame:
    """One assertion for each (source, target, kind, score) edge with both endpoints: its identity, scope, evidence of both sides, rights and confidence.

    Edges whose endpoints aren't both known, and scores outside 0 to 1, are for ``unregistered`` and ``out_of_range`` to tell. records: id, title, license_id,
    url and a map ``provenance``.
    """
    at, basis = evidence_time("provenance", generated_at)
    value = F.sha2(F.to_json(F.struct(F.col("title"), F.array_sort("tags").alias("tags"), F.array_sort("topics").alias("topics"))), 256)
    own = records.select(
        F.col("id"), F.struct(
            F.concat(F.lit("record:"), "id").alias("locator"), at.alias("retrieved_at"), basis.alias("basis"), F.coalesce(F.nullif(F.try_element_at("provenance", F.lit("source_url")), F.lit("")), F.lit("data/governance/release.json")).alias("url"),
            value.alias("value"), F.coalesce("license_id", F.lit("not-evaluated")).alias("license_id"),
        ).alias("e"),
    )
    both = edges.join(own.select(F.col("id").alias("source"), F.col("e").alias("s")), "source").join(own.select(F.col("id").alias("target"), F.col("e").alias("t")), "target")
    similar = F.col("kind") != "cross-source-representation"
    kinds = edges.sparkSession.createDataFrame([(k, *v) for k, v in KINDS.items()], "kind string, predicate string, status string, rule string")
    out = both.join(F.broadcast(kinds), "kind").withColumn("assertion_id", assertion_id(F.col("source"), F.col("predicate"), F.col("target")))
    return out.select(
        "assertion_id", "source", "predicate", "target", "status", "rule", F.when(similar, F.col("score")).alias("confidence"), similar.alias("discovery_only"),
        *(F.col(f"{side}.{f}").alias(f"{name}_{f}") for side, name in (("s", "source"), ("t", "target")) for f in ("locator", "retrieved_at", "basis", "url", "value", "license_id")),
    )


def out_of_range(edges: DataFrame) -> DataFrame:
    """Edges between similar records whose score isn't between 0 and 1."""
    return edges.where((F.col("kind") != "cross-source-representation") & ~F.coalesce(F.col("score").between(0, 1), F.lit(False)))


def grouped_targets(rows: DataFrame, block: int = 64) -> DataFrame:
    """(subject, predicate, block, objects): direct triples, the objects of one subject in blocks so that a hub stays small."""
    own = rows.withColumn("block", F.pmod(F.xxhash64("object"), F.lit(block)))
    return own.groupBy("subject", "predicate", "block").agg(F.sort_array(F.collect_set("object")).alias("objects"))


def disagreement(*projections: DataFrame) -> DataFrame:
    """Rows of (subject, predicate, object) that are not in all projections once, with how often each has them."""
    out = None
    for n, p in enumerate(projections):
        own = p.select("subject", "predicate", "object").withColumn("which", F.lit(n))
        out = own if out is None else out.unionAll(own)
    counts = [F.count_if(F.col("which") == n).alias(f"in_{n}") for n in range(len(projections))]
    got = out.groupBy("subject", "predicate", "object").agg(*counts)
    return got.where(" OR ".join(f"in_{n} <> 1" for n in range(len(projections))))
