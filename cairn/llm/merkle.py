"""Merkle manifest of a dataset: one digest for each row, group and table, a proof for each row, and the check of rows against proofs.

A row's leaf is the SHA-256 of its fields, each written as ``-`` (null) or its length in bytes, ``:`` and its value. The leaves of a group, in
the order of their ids, are the lowest level of its tree; every ``FANOUT`` consecutive nodes, or fewer at the end of a level, become the digest of
their hexadecimal texts, until one node remains, the subroot. Subroots in the order of their groups (null first, then bytewise) make the root in
the same way.

Trees are cut into aligned blocks of ``FANOUT ** LEVELS`` nodes. A block is a matrix of 64-byte rows: a level is reshaped by the fanout and hashed
row by row, and the siblings of a node follow from its number alone. What remains of a block is a node of the next round of blocks, so the largest
group takes as many rounds as its size has digits to the base of a block, and no task ever holds more than one block. Paths come down the same rounds: a
block's row, with the path from it to the root, is sorted before the block's nodes. Only digests, ids and groups are shuffled, never texts.

Ids that repeat in a group are ordered by their leaves, and null ids come first; equal rows have equal leaves and stand beside each other, each with a
proof of its own place. A null text is not an empty one. A very long text is hashed by the JVM where it lies. A lone leaf is its own subroot, and a lone subroot the root; then there is
nothing to prove, and the proof is the digest of nothing. An empty table gives no rows. Further columns may have any name and are no part of a leaf.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.llm.common import column, materialize, runs_of, table
from cairn.scratch import broadcast_if

FANOUT = 3
LEVELS = 8
WIDTH = 64
PATH = "array<struct<slot: int, siblings: string>>"


def leaf_digest(*fields: Column) -> Column:
    """SHA-256, in hexadecimal, of the fields one after another."""
    def written(c: Column) -> Column:
        text = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*map(written, fields)), 256)


# Matrices of digests: a row of 64 bytes for each node.


def matrix(digests: list[str]) -> np.ndarray:
    return np.frombuffer("".join(digests).encode("ascii"), np.uint8).reshape(-1, WIDTH)


def hashed(rows: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
    """The digest of each row, or of its first ``lengths`` bytes, in hexadecimal."""
    rows = np.ascontiguousarray(rows)
    if lengths is None:
        out = b"".join(sha256(r).hexdigest().encode("ascii") for r in rows)
    else:
        out = b"".join(sha256(r[:n]).hexdigest().encode("ascii") for r, n in zip(rows, lengths.tolist(), strict=True))
    return np.frombuffer(out, np.uint8).reshape(-1, WIDTH)


def level_up(nodes: np.ndarray, fanout: int) -> np.ndarray:
    """The next level: runs of ``fanout`` nodes are rows of the reshaped matrix, the last run may be shorter."""
    whole = len(nodes) // fanout
    up = hashed(nodes[: whole * fanout].reshape(whole, fanout * WIDTH))
    return up if whole * fanout == len(nodes) else np.concatenate([up, hashed(nodes[whole * fanout :].reshape(1, -1))])


def levels_of(nodes: np.ndarray, fanout: int, height: int | None) -> list[np.ndarray]:
    """All levels of a block, lowest first: ``height`` steps up, or as many as leave one node."""
    out = [nodes]
    while len(out) <= height if height is not None else len(out[-1]) > 1:
        out.append(level_up(out[-1], fanout))
    return out


def slots(level: np.ndarray, at: np.ndarray, fanout: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the nodes numbered ``at`` of a level: first node of their run, their slot in it, and the run's size."""
    first = at // fanout * fanout
    return first, at - first, np.minimum(fanout, len(level) - first)


def paths_of(levels: list[np.ndarray], fanout: int) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray]]:
    """For each step up: the slot of each leaf's ancestor in its run, its siblings (a matrix for each place) and how many there are."""
    at = np.arange(len(levels[0]))
    for level in levels[:-1]:
        first, slot, size = slots(level, at, fanout)
        others = [np.minimum(first + k + (k >= slot), len(level) - 1) for k in range(fanout - 1)]
        yield slot, [level[o] for o in others], size - 1
        at = at // fanout


def folded(own: np.ndarray, levels: list[np.ndarray], fanout: int) -> np.ndarray:
    """The top that follows from each given leaf with the levels' siblings."""
    at = np.arange(len(own))
    for level in levels[:-1]:
        first, slot, size = slots(level, at, fanout)
        rows = level[np.minimum(first[:, None] + np.arange(fanout), len(level) - 1)]
        rows[np.arange(len(own)), slot] = own
        own = hashed(rows.reshape(len(own), fanout * WIDTH), size * WIDTH)
        at = at // fanout
    return own


def fold_path(own: np.ndarray, path: list[tuple[int, bytes]]) -> np.ndarray:
    """Digests folded along one path that they share."""
    for slot, siblings in path:
        left, right = (np.broadcast_to(np.frombuffer(s, np.uint8), (len(own), len(s))) for s in (siblings[: slot * WIDTH], siblings[slot * WIDTH :]))
        own = hashed(np.concatenate([left, own, right], axis=1))
    return own


# Rounds of blocks.


def numbered(leaves: DataFrame, *ties: str) -> DataFrame:
    """``pos``, the number of a row in its group ``grp`` in the order of ``ties``, and ``n``, the group's rows.

    Rows are dealt by ranges, so a large group lies in many tasks; each task's share of a group is shifted by the shares before it.
    """
    order = [F.col("grp"), *(F.col(t).asc_nulls_first() for t in ties)]
    dealt = materialize(leaves.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "leaves")
    dealt = dealt.withColumn("part", F.shiftright("at", 33))
    shares = dealt.groupBy("grp", "part").agg(F.min("at").alias("begin"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select("grp", "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("begin")).alias("shift"), F.sum("rows").over(Window.partitionBy("grp")).alias("n"))
    return dealt.join(broadcast_if(shares, 200_000), ["grp", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", F.col("pos").asc_nulls_first())


def joined(batches: list[pa.RecordBatch], name: str) -> list:
    return [v for b in batches for v in column(b, name)]


def tops(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(grp, pos, n, digest): what remains of each block, as a node of the next round. ``nodes`` are (grp, pos, n, digest)."""
    size = fanout**levels

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (grp, block), own in runs_of(batches, "grp", "block"):
            n = column(own[0], "n")[0]
            top = levels_of(matrix(joined(own, "digest")), fanout, levels if n > size else None)[-1]
            yield pa.RecordBatch.from_pylist([{"grp": grp, "pos": block, "n": -(-n // size), "digest": top.tobytes().decode("ascii")}])

    return by_block(nodes.select("grp", "pos", "n", "digest", F.expr(f"pos div {size}").alias("block"))).mapInArrow(run, "grp string, pos bigint, n bigint, digest string")


def down(nodes: DataFrame, above: DataFrame, emit: Callable, schema: str, fanout: int, levels: int) -> DataFrame:
    """Each block's nodes with the path from the block upwards: ``emit(grp, batches, levels, path, top)`` makes the result's rows.

    ``above`` is (grp, pos, path, top), one row for each block.
    """
    size = fanout**levels

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (grp, _), own in runs_of(batches, "grp", "block"):
            path, top = column(own[0], "path")[0], column(own[0], "top")[0]
            own = [own[0].slice(1), *own[1:]]
            n = next(b for b in own if b.num_rows).column("n")[0].as_py()
            tree = levels_of(matrix(joined(own, "digest")), fanout, levels if n > size else None)
            yield from emit(grp, own, tree, [(p["slot"], p["siblings"].encode("ascii")) for p in path], top)

    blocks = above.select("grp", F.col("pos").alias("block"), "path", "top")
    return by_block(nodes.withColumn("block", F.expr(f"pos div {size}")).unionByName(blocks, allowMissingColumns=True)).mapInArrow(run, schema)


def climb(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(grp, pos, path, top): the path from each node to the top of its group, and that top."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    if most <= 1:
        return nodes.select("grp", "pos", F.array().cast(PATH).alias("path"), F.col("digest").alias("top"))
    above = climb(materialize(tops(nodes, fanout, levels), "tops"), fanout, levels)

    def emit(grp: str, own: list[pa.RecordBatch], tree: list[np.ndarray], path: list, top: str) -> Iterator[pa.RecordBatch]:
        steps = list(paths_of(tree, fanout))
        rows = []
        for i, pos in enumerate(joined(own, "pos")):
            up = [(int(slot[i]), b"".join(m[i].tobytes() for m in others[: count[i]])) for slot, others, count in steps] + path
            rows.append({"grp": grp, "pos": pos, "path": [{"slot": s, "siblings": x.decode("ascii")} for s, x in up], "top": top})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("path", pa.list_(pa.struct([("slot", pa.int32()), ("siblings", pa.string())]))), ("top", pa.string())]))

    return materialize(down(nodes, above, emit, f"grp string, pos bigint, path {PATH}, top string", fanout, levels), "paths")


def group_key(group: Column) -> Column:
    """A text that orders as the groups do: null before all others."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def verified_manifest(leaves: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``leaves`` (id, group, leaf, found), with ``found`` the leaf of the row as it is now, checked against it.

    Returns id, grp, pos, leaf, subroot, root, ``proof_sha256``, ``folded_root`` (from ``found`` and the manifest's siblings) and ``verified``.
    """
    kind = leaves.schema["id"].dataType.simpleString()
    own = materialize(numbered(leaves.select("id", group_key(F.col("group")).alias("grp"), F.col("leaf").alias("digest"), "found"), "id", "digest"), "numbered")
    up = climb(materialize(tops(own, fanout, levels), "tops"), fanout, levels)
    subroots = up.where("pos = 0").select("grp", F.col("top").alias("digest"))
    places = numbered(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest"), "name")
    of_groups = climb(materialize(places, "groups"), fanout, levels)
    groups = places.join(of_groups.withColumnsRenamed({"path": "rest", "top": "root"}), "pos").select(F.col("name").alias("grp"), "rest", "root")
    above = up.join(groups, "grp").select("grp", "pos", F.concat("path", "rest").alias("path"), F.concat_ws(",", "top", "root").alias("top"))

    def emit(grp: str, rows: list[pa.RecordBatch], tree: list[np.ndarray], path: list, top: str) -> Iterator[pa.RecordBatch]:
        subroot, root = top.split(",")
        n = len(tree[0])
        proofs = [sha256() for _ in range(n)]
        for _, others, count in paths_of(tree, fanout):
            near = np.concatenate(others, axis=1) if others else np.zeros((n, 0), np.uint8)
            for proof, row, k in zip(proofs, np.ascontiguousarray(near), (count * WIDTH).tolist(), strict=True):
                proof.update(row[:k])
        rest = b"".join(siblings for _, siblings in path)
        for proof in proofs:
            proof.update(rest)
        now = fold_path(folded(matrix(joined(rows, "found")), tree, fanout), path)
        leaf, found_root = (pa.array([bytes(r).decode("ascii") for r in m], pa.string()) for m in (tree[0], now))
        ids = pa.concat_arrays([b.column(b.schema.get_field_index("id")) for b in rows])
        same = [r == root for r in found_root.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([grp] * n), pa.array(joined(rows, "pos"), pa.int64()), leaf, pa.array([subroot] * n), pa.array([root] * n), pa.array([p.hexdigest() for p in proofs]), found_root, pa.array(same)],
            ["id", "grp", "pos", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
        )

    schema = f"id {kind}, grp string, pos bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return down(own, above, emit, schema, fanout, levels)


def manifest(docs: DataFrame, fields: Iterable[str], group: str, id_col: str, now: dict[str, Column] | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """The manifest of a table's ``fields``, and whether each row still verifies with the fields replaced by ``now``, its present values."""
    now = now or {}
    own = [docs[f] for f in fields]
    leaves = docs.select(docs[id_col].alias("id"), docs[group].alias("group"), leaf_digest(*own).alias("leaf"), leaf_digest(*(now.get(f, docs[f]) for f in fields)).alias("found"))
    return verified_manifest(leaves, fanout, levels)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under their sources. Where 2 divides crc32 of the id, the text is read without its line feeds, and fails where it had any."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 2 == 0, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"])
    out = manifest(docs, ("doc_id", "source", "lang", "n_chars", "text"), "source", "doc_id", {"text": tampered})
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


#: Level by level over all trees at once; crc32 is worked out bit by bit, 3988292384 being the polynomial.
OP11_SQL = r"""
WITH RECURSIVE given AS (
    SELECT doc_id, source, text, concat(
             CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(doc_id::VARCHAR), ':', doc_id) END, CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END,
             CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END, CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(n_chars::VARCHAR), ':', n_chars) END) AS head,
           xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
             lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, bit: xor(v >> 1, (v & 1) * 3988292384)))) AS crc
    FROM documents
), leaves AS (
    SELECT *, sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END)) AS leaf,
           sha256(concat(head, CASE WHEN text IS NULL THEN '-' WHEN crc % 2 = 0 THEN concat(strlen(replace(text, chr(10), '')), ':', replace(text, chr(10), '')) ELSE concat(strlen(text), ':', text) END)) AS found
    FROM given
), placed AS (
    SELECT doc_id, coalesce('=' || source, '') AS grp, leaf, found, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves
), low AS (
    SELECT 0 AS lvl, grp, pos, n, leaf AS digest FROM placed
    UNION ALL
    SELECT lvl + 1, grp, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY lvl, grp, pos // 3, n
), subroots AS (
    SELECT grp, digest AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1
), high AS (
    SELECT 0 AS lvl, pos, n, subroot AS digest FROM subroots
    UNION ALL
    SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY lvl, pos // 3, n
), up AS (
    SELECT p.grp, p.pos, l.lvl, coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < l.at), '') AS before, coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > l.at), '') AS behind
    FROM placed p JOIN (SELECT grp, pos, unnest(range(0, 40)) AS lvl, pos // (3 ** unnest(range(0, 40)))::HUGEINT AS at FROM placed WHERE n > 1) l ON l.grp = p.grp AND l.pos = p.pos
    JOIN low s ON s.grp = l.grp AND s.lvl = l.lvl AND s.n > 1 AND s.pos // 3 = l.at // 3
    GROUP BY ALL
    UNION ALL
    SELECT p.grp, p.pos, 100 + l.lvl, coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < l.at), ''), coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > l.at), '')
    FROM placed p JOIN (SELECT grp, unnest(range(0, 40)) AS lvl, pos // (3 ** unnest(range(0, 40)))::HUGEINT AS at FROM subroots) l ON l.grp = p.grp
    JOIN high s ON s.lvl = l.lvl AND s.n > 1 AND s.pos // 3 = l.at // 3
    GROUP BY ALL
), proofs AS (
    SELECT grp, pos, string_agg(before || behind, '' ORDER BY lvl) AS proof, list({'b': before, 'h': behind} ORDER BY lvl) AS steps FROM up GROUP BY grp, pos
)
SELECT p.doc_id, p.leaf, s.subroot, r.digest AS root, sha256(coalesce(f.proof, '')) AS proof_sha256,
       list_reduce(list_prepend({'b': p.found, 'h': ''}, coalesce(f.steps, [])), lambda x, y: {'b': sha256(y.b || x.b || y.h), 'h': ''}).b AS folded_root,
       list_reduce(list_prepend({'b': p.found, 'h': ''}, coalesce(f.steps, [])), lambda x, y: {'b': sha256(y.b || x.b || y.h), 'h': ''}).b = r.digest AS verified
FROM placed p JOIN subroots s USING (grp) LEFT JOIN proofs f ON f.grp = p.grp AND f.pos = p.pos CROSS JOIN (SELECT digest FROM high WHERE n = 1) r
"""
