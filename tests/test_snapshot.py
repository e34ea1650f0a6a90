"""Digest trees, the descent to changed rows, and the rules on files, headers and receipts."""

from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from cairn.operators import snapshot


def h(s: str) -> str:
    return sha256(s.encode()).hexdigest()


def root(rows: list[tuple[str, str]]) -> str:
    below = sorted({(h(k), h(v)) for k, v in rows})
    for digits in (6, 4, 2, 0):
        groups: dict[str, list] = {}
        for prefix, digest in below:
            groups.setdefault(prefix[:digits], []).append((prefix, digest))
        below = sorted((p, h(",".join(d for _, d in sorted(g)))) for p, g in groups.items())
    return below[0][1]


def tree(spark, rows, partitions=3):
    df = spark.createDataFrame(rows, "file string, key string, content string").repartition(partitions)
    return snapshot.digest_tree(df, F.col("key"), F.col("content"))


ROWS = [(f, f"k{i}", f"v{i}") for f in ("a", "b") for i in range(300)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_roots_by_definition(spark, partitions):
    got = {r.file: (r.digest, r.n) for r in tree(spark, ROWS + [("c", "k", None), (None, "k", "v")], partitions).roots().collect()}
    want = {f: (root([(k, v) for g, k, v in ROWS if g == f]), 300) for f in ("a", "b")} | {"c": (root([("k", "")]), 1), None: (root([("k", "v")]), 1)}
    assert got == want


def test_descent_names_the_rows(spark):
    after = [r for r in ROWS if r[:2] != ("a", "k7")] + [("a", "new", "v"), ("gone", "k", "v")]
    after = [(f, k, "other" if (f, k) in {("a", "k9"), ("a", "k200")} else v) for f, k, v in after]
    got = snapshot.descend(tree(spark, ROWS), tree(spark, after)).collect()
    assert sorted(map(tuple, got)) == [("a", "k200", "changed"), ("a", "k7", "missing"), ("a", "k9", "changed"), ("a", "new", "added")]
    assert snapshot.descend(tree(spark, ROWS), tree(spark, ROWS, 9)).count() == 0


def test_repeated_keys(spark):
    before = [("a", "k", "1"), ("a", "k", "2"), ("a", "k", "2"), ("a", "x", "1")]
    assert [tuple(r) for r in snapshot.descend(tree(spark, before), tree(spark, before[1:])).collect()] == [("a", "k", "missing")]


def registers(spark, *changes):
    """Register, statement and finding of one file, with columns changed in each."""
    row = {"file": "a", "source_id": "s", "records": 3, "record_set": "r", "receipts": 1, "receipt_set": "p", "incomplete": 0, "digest": "d"}
    return [spark.createDataFrame([row | c], "file string, source_id string, records long, record_set string, receipts long, receipt_set string, incomplete long, digest string") for c in changes]


@pytest.mark.parametrize(
    ("changes", "rules"),
    [
        (({}, {}, {}), []),
        (({}, {"source_id": "t"}, {}), ["source identity"]),
        (({"source_id": " "}, {"source_id": " "}, {}), ["source identity"]),
        (({}, {"records": 4}, {}), ["stated record count"]),
        (({}, {}, {"records": 2, "record_set": "q", "digest": "e"}), ["file digest", "registered record count", "registered record set", "stated record count", "stated record set"]),
        (({}, {"receipt_set": None}, {"incomplete": 1}), ["incomplete receipt", "stated receipt set"]),
        (({"file": "../a"}, {"file": "../a"}, {"file": "../a"}), ["unsafe file name"]),
        (({}, {}, {"file": "b"}), ["file is missing", "file is not registered"]),
    ],
)
def test_file_rules(spark, changes, rules):
    assert sorted(r.rule for r in snapshot.file_faults(*registers(spark, *changes)).collect()) == rules


def test_header_rules(spark):
    schema = "snapshot_id string, schema string, metadata_only boolean, observations_included boolean, files int, total long, counted long"
    good = ("s", "frozen-snapshot.v1", True, False, 1, 5, 5)
    cases = {"": good, "schema": ("s", "v2", *good[2:]), "metadata_only": (*good[:2], None, *good[3:]), "observations_included": (*good[:3], True, *good[4:]), "snapshot id": (" ", *good[1:]), "no files": (*good[:4], 0, 5, 5), "unique records": (*good[:6], 4)}
    for rule, row in cases.items():
        got = [r.rule for r in snapshot.header_faults(spark.createDataFrame([row], schema)).collect()]
        assert got == ([rule] if rule else [])


def test_lineage(spark):
    schema = "file string, page long, url string, content string"
    base = spark.createDataFrame([("a", 0, "u0", "c0"), ("a", 1, "u1", "c1"), ("b", 0, "u", "c")], schema)
    after = spark.createDataFrame([("a", 0, "u0", "c0"), ("a", 1, "u1", "other"), ("a", 2, "more", "c")], schema)
    assert sorted(map(tuple, snapshot.lineage_faults(base, after).collect())) == [("a", 1, "changed"), ("b", 0, "missing")]
