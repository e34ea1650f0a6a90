"""Frozen snapshots: a tree of digests for each file's rows, checked from the rows upwards and descended to the rows that changed.

A row's place in the tree is the hash of its key, so a row that comes or goes changes the nodes above it and no others. A node joins the digests of the
nodes below, whose prefixes are two hexadecimal digits longer, in order; the node of the empty prefix stands for the file. Two snapshots
are compared from there: only nodes below a pair that differs are read on, down to single rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.ledger import LEVELS
from cairn.operators.validate import violations
from cairn.scratch import materialize


@dataclass(frozen=True)
class Tree:
    """``leaves`` (file, key, h, digest) and ``nodes`` (file, digits, prefix, digest, n)."""

    leaves: DataFrame
    nodes: DataFrame

    def roots(self) -> DataFrame:
        return self.nodes.where("digits = 0").select("file", "digest", "n")


def digest_tree(rows: DataFrame, key: Column, content: Column) -> Tree:
    """The trees of all files. ``rows`` have a column ``file``; of rows with one key each distinct content is a leaf, null contents count as empty."""
    digest = F.sha2(F.coalesce(content, F.lit("")), 256)
    leaves = materialize(rows.select("file", key.alias("key"), F.sha2(key.cast("string"), 256).alias("h"), digest.alias("digest")).where("key IS NOT NULL").distinct(), "leaves")
    levels, below = [], leaves.select("file", F.col("h").alias("prefix"), "digest", F.lit(1).cast("long").alias("n"))
    for digits in LEVELS:
        own = F.transform(F.sort_array(F.collect_list(F.struct("prefix", "digest"))), lambda x: x["digest"])
        below = below.groupBy("file", F.left("prefix", F.lit(digits)).alias("prefix")).agg(F.sha2(F.array_join(own, ","), 256).alias("digest"), F.sum("n").alias("n"))
        if digits == LEVELS[0]:  # the largest level, from which those above are worked out
            below = materialize(below, "nodes")
        levels.append(below.select("file", F.lit(digits).alias("digits"), "prefix", "digest", "n"))
    return Tree(leaves, materialize(reduce(DataFrame.unionAll, levels), "tree"))


def unequal(before: DataFrame, after: DataFrame, on: list[str]) -> DataFrame:
    """Keys whose digests differ or that one side lacks, as ``fault``."""
    both = before.select(*on, F.col("digest").alias("old")).join(after.select(*on, F.col("digest").alias("new")), on, "full")
    fault = F.when(F.col("new").isNull(), "missing").when(F.col("old").isNull(), "added").otherwise("changed")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select(*on, fault.alias("fault"))


def descend(before: Tree, after: Tree) -> DataFrame:
    """(file, key, fault): rows changed, missing or added in files that both snapshots have."""
    open_, last = unequal(before.roots(), after.roots(), ["file"]).where("fault = 'changed'").select("file", F.lit("").alias("above")), 0
    for digits in (*sorted(LEVELS)[1:], None):
        sides = []
        for tree in (before, after):
            own = tree.nodes.where(F.col("digits") == digits) if digits else tree.leaves.withColumn("prefix", F.col("h"))
            sides.append(own.withColumn("above", F.left("prefix", F.lit(last))).join(open_, ["file", "above"], "left_semi"))
        if digits is None:
            return leaf_faults(*sides)
        open_ = unequal(*sides, ["file", "prefix"]).select("file", F.col("prefix").alias("above"))
        last = digits
    raise AssertionError


def leaf_faults(before: DataFrame, after: DataFrame) -> DataFrame:
    """Leaves of a key that one side lacks; a key that both have with unlike contents is changed, and named once."""
    gone = lambda a, b: a.select("file", "key", "digest").join(b.select("file", "key", "digest"), ["file", "key", "digest"], "left_anti")
    sides = gone(before, after).withColumn("side", F.lit("missing")).unionAll(gone(after, before).withColumn("side", F.lit("added")))
    return sides.groupBy("file", "key").agg(F.when(F.countDistinct("side") == 2, "changed").otherwise(F.min("side")).alias("fault"))


def file_digest(source: Column, records: Column, record_set: Column, receipt_set: Column) -> Column:
    return F.sha2(F.concat_ws("\n", source, records.cast("string"), record_set, receipt_set), 256)


def recount(sources: DataFrame, records: Tree, receipts: Tree, incomplete: DataFrame | None = None) -> DataFrame:
    """What files hold: (file, source_id, records, record_set, receipts, receipt_set, incomplete, digest).

    ``sources`` are (file, source_id); ``incomplete`` counts each file's receipts without an address or a digest, as (file, incomplete).
    """
    own = sources.join(records.roots().select("file", F.col("n").alias("records"), F.col("digest").alias("record_set")), "file", "left")
    own = own.join(receipts.roots().select("file", F.col("n").alias("receipts"), F.col("digest").alias("receipt_set")), "file", "left")
    own = own.join(incomplete, "file", "left") if incomplete is not None else own.withColumn("incomplete", F.lit(0).cast("long"))
    own = own.fillna(0, ["records", "receipts", "incomplete"])
    return own.withColumn("digest", file_digest(F.col("source_id"), F.col("records"), F.col("record_set"), F.col("receipt_set")))


def file_faults(registered: DataFrame, stated: DataFrame, found: DataFrame) -> DataFrame:
    """(file, rule) for files of the register (``registered``), of what files say of themselves (``stated``) and of what they hold (``found``).

    A file that isn't there, or isn't registered, breaks that rule alone.
    """
    side = lambda df, name: df.select("file", F.struct(*(c for c in df.columns if c != "file")).alias(name))
    rows = side(registered, "r").join(side(stated, "s"), "file", "full").join(side(found, "f"), "file", "full")
    there = F.col("f").isNotNull() & F.col("r").isNotNull()
    equal = lambda a, b: ~there | F.col(a).eqNullSafe(F.col(b))
    return violations(
        rows,
        "file",
        {
            "file is missing": F.col("r").isNull() | F.col("f").isNotNull(),
            "file is not registered": F.col("r").isNotNull(),
            "unsafe file name": ~there | F.col("file").rlike(r"^[^/\\\x00]+$") & ~F.col("file").isin(".", ".."),
            "source identity": ~there | (F.trim("r.source_id") != "") & F.col("r.source_id").eqNullSafe(F.col("s.source_id")),
            "stated record count": equal("s.records", "f.records"),
            "registered record count": equal("r.records", "f.records"),
            "stated record set": equal("s.record_set", "f.record_set"),
            "registered record set": equal("r.record_set", "f.record_set"),
            "incomplete receipt": ~there | (F.col("f.incomplete") == 0),
            "stated receipt set": equal("s.receipt_set", "f.receipt_set"),
            "registered receipt set": equal("r.receipt_set", "f.receipt_set"),
            "file digest": equal("r.digest", "f.digest"),
        },
    )


#: What a snapshot's header must say.
HEADER = {"schema": "frozen-snapshot.v1", "metadata_only": "true", "observations_included": "false"}


def header_faults(headers: DataFrame) -> DataFrame:
    """(snapshot_id, rule) for headers (snapshot_id, schema, metadata_only, observations_included, files, total, counted): ``total`` is the register's sum of counts, ``counted`` the unique records."""
    rules = {name: F.col(name).cast("string") == value for name, value in HEADER.items()}
    rules |= {"snapshot id": F.trim("snapshot_id") != "", "no files": F.col("files") > 0, "unique records": F.col("total") == F.col("counted")}
    return violations(headers, "snapshot_id", rules)


def lineage_faults(base: DataFrame, successor: DataFrame) -> DataFrame:
    """(file, page, fault): receipts of a base snapshot, by their place in the file, that its successor lacks or has changed. Further receipts may follow the base's."""
    receipt = ["file", "page", "url", "content"]
    both = base.select(*receipt).join(successor.select("file", "page", F.col("url").alias("new_url"), F.col("content").alias("new_content")), ["file", "page"], "left")
    same = F.col("url").eqNullSafe(F.col("new_url")) & F.col("content").eqNullSafe(F.col("new_content"))
    gone = F.col("new_url").isNull() & F.col("new_content").isNull()
    return both.where(~same).select("file", "page", F.when(gone, "missing").otherwise("changed").alias("fault"))
