"""N-gram Jaccard join by chosen paths.

Texts become sets of hashed five-word shingles. In each run every set chooses, at each level, each of its shingles
with probability 1 / (similarity x size): one and a quarter on average. Sets that chose the same shingle share a
bucket; buckets over a size are split again on the shingles chosen at the next level, unless nearly all of a bucket's
sets stay together. A pair as similar as the threshold shares a chosen shingle in one run with probability of at
least 0.63 (one level) to 0.37 (three); the number of runs follows from the recall wanted of the deepest.

Small buckets are compared by brute force, larger ones that can't be split further in pairs of blocks. A pair that
shares several buckets belongs to the least of them, so each link counts once without any list of pairs. A first
comparison on min-hash signatures tells which texts need their exact sets; then exact Jaccard similarities decide.
Comparisons return, for each text, its number of links and the root of its group in the block: never pairs.

Equal texts are copies and enter once. Null texts are classes of their own; texts without words have no
links, and equal ones are copies. A text of fewer than five words is one shingle. Order and repetition of rows
don't matter; the class id is the least id of the class. Very long texts are sets like others, of as many shingles. An empty table gives an
empty result, and further columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import WordHash, column, free_name, materialize, mix, rows_of, shingles, table, text_key, words
from cairn.llm.components import components

LEVELS = 3
SIGNATURE = 128
SMALL_BUCKET = 64
BLOCK = 1024
#: Texts whose exact sets are needed are broadcast by key up to this number (16 bytes each), joined by a shuffle beyond.
BROADCAST_KEYS = 100_000


def runs_for(recall: float) -> int:
    """Runs after which a pair at the threshold has shared a bucket on the deepest level with probability ``recall``."""
    p = 1.0
    for _ in range(LEVELS):
        p = 1 - math.exp(-p)
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def shingle_sets(texts: list[str | None], hashes: WordHash, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text in one array, and how many each has."""
    sets = [np.unique(shingles(hashes.of(words(t or "")), width)) for t in texts]
    return np.concatenate([*sets, np.zeros(0, np.uint64)]), np.array([len(s) for s in sets], np.int64)


def sketches(docs: DataFrame, similarity: float, runs: int, width: int) -> DataFrame:
    """(key, n, chosen, signature, id, copies) of each distinct text with words; ``chosen`` holds shingle hashes with the run and level in the low bits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for part, texts in rows_of(batches, "text", 128):
            tokens, n = shingle_sets(texts, hashes, width)
            begins = np.cumsum(n) - n
            owner = np.repeat(np.arange(len(n)), n)
            bound = np.minimum(2.0**64 / (similarity * np.maximum(n, 1)), 2.0**64 - 2048).astype(np.uint64)[owner]
            picked_by, picked = [], []
            for code in range(runs * LEVELS):
                h = mix(tokens, code)
                hit = np.flatnonzero(h <= bound)
                picked_by.append(owner[hit])
                picked.append(((mix(tokens[hit], 7) & ~np.uint64(0xFFF)) | np.uint64(code)).view(np.int64))
            by = np.concatenate(picked_by)
            order = np.argsort(by, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(by, minlength=len(n)))])
            chosen = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(picked)[order]))
            full = n > 0
            signature = np.zeros((len(n), SIGNATURE), np.uint8)
            if full.any():
                for k in range(SIGNATURE // 8):
                    # eight signature bytes come from eight min-hashes, each by rotating one mixed value
                    base = mix(tokens, 10_000 + k)
                    for r in range(8):
                        turned = (base * np.uint64(2 * r + 1)) ^ (base >> np.uint64(8 * r + 4))
                        least = np.minimum.reduceat(mix(turned, r) if r else base, begins[full])
                        signature[full, 8 * k + r] = (least >> np.uint64(20)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [*part.select(["key", "id"]).columns, pa.array(n, pa.int32()), chosen, pa.array([s.tobytes() for s in signature], pa.binary())], ["key", "id", "n", "chosen", "signature"]
            )

    kind = docs.schema["id"].dataType.simpleString()
    made = docs.mapInArrow(run, f"key binary, id {kind}, n int, chosen array<bigint>, signature binary")
    rest = [F.first(c).alias(c) for c in ("n", "chosen", "signature")]
    return made.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), *rest)


def code_of(c: Column) -> Column:
    return c.bitwiseAND(F.lit(0xFFF))


def leaves(sketch: DataFrame) -> DataFrame:
    """(bucket, key, size): buckets to compare, of two texts at least."""
    level = lambda c: F.pmod(code_of(c), F.lit(LEVELS))
    first = F.filter("chosen", lambda c: level(c) == 0)
    rows = sketch.where("n > 0").select("key", F.explode(first).alias("c")).select("key", F.floor(code_of(F.col("c")) / LEVELS).alias("run"), F.xxhash64("c").alias("bucket"))
    done = None
    parent = F.lit(None).cast("long")
    for depth in range(LEVELS):
        size = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        rows = rows.join(size, "bucket")
        last = depth == LEVELS - 1
        closed = F.lit(True) if last else (F.col("size") <= SMALL_BUCKET) | F.coalesce(F.col("size") >= 0.8 * parent, F.lit(False))
        rows = materialize(rows.withColumn("closed", closed), "buckets")
        own = rows.where("closed").select("bucket", "key", "size")
        done = own if done is None else done.unionAll(own)
        if last:
            break
        open_ = rows.where("NOT closed").select("bucket", "key", "run", F.col("size").alias("parent"))
        if open_.isEmpty():
            break
        next_ = F.filter("chosen", lambda c: code_of(c) == F.col("run") * LEVELS + depth + 1)
        rows = open_.join(sketch.select("key", "chosen"), "key").select("key", "run", "parent", F.col("bucket").alias("above"), F.explode(next_).alias("c"))
        rows = rows.select("key", "run", "parent", F.xxhash64("above", "c").alias("bucket"))
        parent = F.col("parent")
    return done


def in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of a bucket spread over the pairs of its blocks that hold them; sorted within each task."""
    n = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key"), n).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other", "size")
    return rows.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")


def groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows with equal (bucket, low, high), also across batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        b, lo, hi = (np.asarray(batch[c]) for c in ("bucket", "low", "high"))
        cuts = np.flatnonzero((b[1:] != b[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for i, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            part = batch.slice(x, y - x)
            if held and (i or any(held[-1][c][0] != part[c][0] for c in ("bucket", "low", "high"))):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def lists(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and the row of each."""
    col = col.combine_chunks()
    return np.asarray(col.flatten()), np.repeat(np.arange(len(col)), np.asarray(col.value_lengths()))


def owned(rows: pa.Table, bucket: int) -> np.ndarray:
    """Pairs to compare here: those of the two blocks that share no lesser bucket. Only i < j counts."""
    block, lo, hi = np.asarray(rows["block"]), rows["low"][0].as_py(), rows["high"][0].as_py()
    pairs = np.triu(np.ones((len(block),) * 2, bool), 1)
    if lo != hi:
        pairs &= block[:, None] != block[None, :]
    value, row = lists(rows["leaves"])
    lesser = value < bucket
    if lesser.any():
        names, at = np.unique(value[lesser], return_inverse=True)
        shared = np.bincount(at) > 1
        if shared.any():
            number = np.cumsum(shared) - 1
            incidence = np.zeros((len(block), int(shared.sum())), np.float32)
            incidence[row[lesser][shared[at]], number[at][shared[at]]] = 1
            pairs &= (incidence @ incidence.T) == 0
    return pairs


def candidates(rows: DataFrame, least: float) -> DataFrame:
    """(bucket, key) of texts whose signature nearly matches that of another text in a pair that the bucket owns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, keys = [], []
        for group in groups(batches):
            if group.num_rows < 2:
                continue
            bucket = group["bucket"][0].as_py()
            sig = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint8).reshape(-1, SIGNATURE)
            pairs = owned(group, bucket)
            near = np.zeros(len(sig), bool)
            for i in range(len(sig)):
                with_ = np.flatnonzero(pairs[i])
                hit = with_[(sig[with_] == sig[i]).sum(1) >= least * SIGNATURE]
                if len(hit):
                    near[i] = near[hit] = True
            for i in np.flatnonzero(near):
                buckets.append(bucket)
                keys.append(group["key"][int(i)].as_py())
            if len(keys) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(keys, pa.binary())], ["bucket", "key"])
                buckets, keys = [], []
        yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array(keys, pa.binary())], ["bucket", "key"])

    return rows.mapInArrow(run, "bucket bigint, key binary").distinct()


def links(rows: DataFrame, similarity: float) -> DataFrame:
    """(key, root, n): links of each text in each block, by exact similarity, and the least key it is connected with there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            m = group.num_rows
            if m < 2:
                continue
            pairs = owned(group, group["bucket"][0].as_py())
            value, row = lists(group["tokens"])
            size = np.bincount(row, minlength=m)
            _, at = np.unique(value, return_inverse=True)
            often = np.bincount(at) > 1
            number = np.cumsum(often) - 1
            keep = often[at]
            at, row = number[at[keep]], row[keep]
            common = np.zeros((m, m), np.float32)
            order = np.argsort(at, kind="stable")
            at, row = at[order], row[order]
            for start in range(0, int(often.sum()), 4096):
                a, b = np.searchsorted(at, [start, start + 4096])
                part = np.zeros((m, 4096), np.float32)
                part[row[a:b], at[a:b] - start] = 1
                common += part @ part.T
            linked = pairs & (common >= similarity * (size[:, None] + size[None, :] - common) - 1e-6)
            linked |= linked.T
            n = linked.sum(1)
            keys = group["key"].to_pylist()
            rank = np.argsort(np.argsort(np.array(keys, object), kind="stable"))
            label = rank.copy()
            while True:
                best = np.minimum(label, np.where(linked, label[None, :], m).min(1))
                if (best == label).all():
                    break
                label = best
            by_rank = sorted(keys)
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in hit], pa.binary()), pa.array([by_rank[label[i]] for i in hit], pa.binary()), pa.array(n[hit], pa.int64())], ["key", "root", "n"]
            )

    return rows.mapInArrow(run, "key binary, root binary, n bigint")


def exact_sets(docs: DataFrame, keys: DataFrame, n_keys: int, width: int) -> DataFrame:
    """(key, tokens) of the wanted texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for part, texts in rows_of(batches, "text", 128):
            tokens, n = shingle_sets(texts, hashes, width)
            made = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(tokens.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(column(part, "key"), pa.binary()), made], ["key", "tokens"])

    wanted = docs.select("key", "text").join(F.broadcast(keys) if n_keys <= BROADCAST_KEYS else keys, "key", "left_semi")
    return wanted.groupBy("key").agg(F.first("text").alias("text")).mapInArrow(run, "key binary, tokens array<bigint>")


def jaccard_join(docs: DataFrame, similarity: float = 0.8, recall: float = 0.995, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, key, class_id, n_links (other texts at least that similar) and n_copies (rows with this text)."""
    own = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    known = own.where(F.col("key").isNotNull())
    sketch = materialize(sketches(known, similarity, runs_for(recall), width), "sketches")
    leaf = materialize(leaves(sketch), "leaves")
    of_text = leaf.groupBy("key").agg(F.sort_array(F.collect_list("bucket")).alias("leaves"))
    of_text = materialize(of_text.join(sketch.select("key", "signature"), "key"), "signed")
    near = candidates(in_blocks(leaf.join(of_text, "key")), similarity - 0.16)
    near = materialize(near, "near")
    keys = materialize(near.select("key").distinct(), "near-keys")
    sets = exact_sets(known, keys, keys.count(), width)
    sets = materialize(sets.join(of_text.select("key", "leaves"), "key"), "sets")
    sizes = near.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    found = materialize(links(in_blocks(near.join(sizes, "bucket").join(sets, "key")), similarity), "found")
    joined = components(found, "key", "root")
    texts = sketch.select("key", "id", "copies").join(joined.withColumnRenamed("node", "key"), "key", "left")
    texts = texts.withColumn("root", F.coalesce("root", "key"))
    class_id = texts.groupBy("root").agg(F.min("id").alias("class_id"))
    n_links = found.groupBy("key").agg(F.sum("n").alias("n_links"))
    texts = materialize(texts.join(class_id, "root").join(n_links, "key", "left").select("key", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "copies"), "classes")
    out = own.select("id", "key").join(texts, "key", "left")
    return out.select(
        F.col("id").alias("doc_id"), "key", F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def one_of_each(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, but one only of each class: that with the least id. Rows without a text all stay."""
    found = jaccard_join(docs, similarity, id_col=id_col, text_col=text_col)
    id_, key, own = (free_name(docs.columns, c) for c in ("id", "key", "own"))
    stay = found.where(F.col("doc_id").eqNullSafe(F.col("class_id")) & F.col("key").isNotNull()).select(F.col("doc_id").alias(id_), F.col("key").alias(key)).distinct()
    keyed = docs.withColumn(own, text_key(docs[text_col]))
    with_text = keyed.join(stay, keyed[id_col].eqNullSafe(F.col(id_)) & (F.col(own) == F.col(key)), "left_semi").dropDuplicates([id_col, own])
    return with_text.unionByName(keyed.where(F.col(own).isNull())).select(docs.columns)


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


OP8_SQL = r"""
WITH RECURSIVE t AS (SELECT text, min(doc_id) AS id, count(*) AS n_copies, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
 FROM documents WHERE text IS NOT NULL GROUP BY text),
s AS (SELECT DISTINCT id, array_to_string(w[p:p + 4], ' ') AS g FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM t WHERE len(w) > 0)),
z AS (SELECT id, count(*) AS n FROM s GROUP BY id),
c AS (SELECT a.id AS x, b.id AS y, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.id <> b.id GROUP BY 1, 2),
e AS (SELECT x, y FROM c JOIN z zx ON zx.id = x JOIN z zy ON zy.id = y WHERE 5 * m >= 4 * (zx.n + zy.n - m)),
r(x, y) AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y),
k AS (SELECT x, min(least(x, y)) AS class_id FROM r GROUP BY x),
l AS (SELECT x, count(*) AS n FROM e GROUP BY x)
SELECT d.doc_id, coalesce(k.class_id, t.id, d.doc_id) AS class_id, CAST(coalesce(l.n, 0) AS BIGINT) AS n_links, CAST(coalesce(t.n_copies, 1) AS BIGINT) AS n_copies
FROM documents d LEFT JOIN t ON t.text = d.text LEFT JOIN k ON k.x = t.id LEFT JOIN l ON l.x = t.id
"""
