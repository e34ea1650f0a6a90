from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from cairn.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(s: str) -> str:
    return sha256(s.encode()).hexdigest()


def leaf(row: tuple) -> str:
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes: list[str], fanout: int) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """The top, and for every leaf its (siblings before, siblings after) from below."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = range(a // fanout * fanout, min(a // fanout * fanout + fanout, len(nodes)))
            paths[i].append(([nodes[j] for j in run if j < a], [nodes[j] for j in run if j > a]))
        at = [a // fanout for a in at]
        nodes = [h("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def brute(rows: list[tuple], now: dict, fanout: int) -> list[tuple]:
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    own = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in order}
    tops = {g: tree([leaf(r) for r in own[g]], fanout) for g in order}
    root, rest = tree([tops[g][0] for g in order], fanout)
    out = []
    for g, more in zip(order, rest, strict=True):
        for r, path in zip(own[g], tops[g][1], strict=True):
            node = leaf((*r[:4], now.get(r[4], r[4])))
            for before, after in path + more:
                node = h("".join([*before, node, *after]))
            out.append((r[0], leaf(r), tops[g][0], root, h("".join("".join(b + a) for b, a in path + more)), node, node == root))
    return sorted(out, key=str)


def found(spark, rows, fanout, levels, now=None):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    changed = {"text": F.when(docs["text"] == "old", "new").otherwise(docs["text"])}
    out = merkle.manifest(docs, FIELDS, "source", "doc_id", changed, fanout, levels)
    return sorted((tuple(r) for r in out.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize(("fanout", "levels"), [(3, 1), (3, 2), (2, 1), (3, 8)])
def test_against_plain_trees(spark, fanout, levels):
    sizes = {"hot": 41, "é": 10, "z": 9, "b": 4, "one": 1, "": 2, None: 5}
    rows = [(100 * k + i, g, "en" if i % 3 else None, i, "old" if i % 4 == 0 else f"t\n{i}é") for k, (g, n) in enumerate(sizes.items()) for i in range(n)]
    rows += [(None, "b", None, None, None), (None, "b", None, None, "x"), (7, "hot", "en", 1, "same"), (7, "hot", "en", 1, "same"), (3, "z", None, None, "")]
    assert found(spark, rows, fanout, levels) == brute(rows, {"old": "new"}, fanout)


def test_lone_and_empty(spark):
    rows = [(1, "s", "en", 3, "old")]
    got = found(spark, rows, 3, 8)
    assert got == brute(rows, {"old": "new"}, 3)
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == h("") and not got[0][6]
    assert found(spark, [], 3, 8) == []


def test_many_groups(spark):
    rows = [(i, f"g{i % 30}", "en", i, "old" if i % 50 == 0 else str(i)) for i in range(90)]
    assert found(spark, rows, 3, 1) == brute(rows, {"old": "new"}, 3)


def test_same_whatever_the_partitions_and_the_further_columns(spark):
    rows = [(i, "s" if i % 3 else "t", "en", i, "word " * (50_000 if i == 4 else i)) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    more = docs.withColumns({c: F.lit(1) for c in ("grp", "at", "part", "leaf", "digest", "pos", "block", "id", "path")}).repartition(7)
    plain = merkle.manifest(docs.coalesce(1), FIELDS, "source", "doc_id", levels=2)
    assert sorted(map(str, plain.collect())) == sorted(map(str, merkle.manifest(more, FIELDS, "source", "doc_id", levels=2).collect()))
    assert plain.where("not verified").count() == 0
