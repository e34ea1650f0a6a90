"""Approximate nearest neighbours by greatest inner product, over an inverted multi-index.

Each half of a vector is quantised by its own codebook, so a vector lies in the cell of a pair of centroids. A query's products with the centroids of both
halves order all pairs: a heap walks them from the greatest sum downwards, and because the sums are monotone, the cells a walk has seen are, for each first
centroid, a prefix of the second ones in that query's order. A query is therefore sent to the first centroids it has reached with the length of each prefix.

There are two walks. The first takes cells until they hold ``FIRST`` rows for each neighbour wanted; its entries are ranked by exact products, which
gives a score that the neighbours must reach. The second goes on until the rows expected to reach that score in the cells not yet seen are fewer than
``1 - recall`` of the neighbours wanted; a cell's rows are taken to be spread about the product with its centroids as its residuals are. So no number of candidates or
partners is ever cut: where vectors have no structure, a walk simply goes through most cells, and ``recall=1`` goes through all.

Equal vectors are one entry with their least ids, one more than are wanted: with ties to the smaller id no other copy can be among the nearest. Equal queries are walked
once. The cells of one first centroid are dealt to as many blocks of ``BLOCK`` entries as they need, and a block's queries stream past its matrix, so neither a popular
cell nor a popular query is gathered in a task. Codebooks are learnt on at most ``SAMPLE`` distinct vectors; their number of centroids grows with the fourth root of the
rows, up to ``MOST_CENTROIDS`` for each half, so what is broadcast (centroids, rows in each cell) is bounded.

Vectors that are null, empty, zero or hold a null, NaN or infinity take no part, nor do rows without an id or with another dimension than the sample's most frequent
one. Rows that repeat id and vector count once. Rows that share an id and not the vector are searched each by itself, and none finds another of that id. Scores are sums of products in double precision, from the first component to the
last; equal scores are ordered by id. A query with fewer candidates than wanted returns all of them that have been found. Empty tables give no rows, further columns may have any name.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from math import erfc

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.llm.common import column, materialize, parts_of, table

TOP = 20
SAMPLE = 20_000
MOST_CENTROIDS = 1_024
ROUNDS = 12
BLOCK = 1_024
FIRST = 50
RECALL = 0.97
#: Queries whose products with a block are worked out together.
TOGETHER = 512
#: Products of matrices may differ in the last places from the sums that count.
SLACK = 1e-9


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, key, dim, vec): the vectors that take part, as bytes of doubles, with 128 bits that stand for them."""
    own = vectors.where(vectors[id_col].isNotNull() & vectors[vector_col].isNotNull()).select(vectors[id_col].cast("bigint").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("vec"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ids, keys, dims, data = [], [], [], []
            for vec_id, one in zip(column(batch, "vec_id"), lists, strict=True):
                values = one.values
                if values is None or not len(values) or values.null_count:
                    continue
                x = values.to_numpy(zero_copy_only=False) + 0.0  # -0.0 becomes 0.0
                if np.isfinite(x).all() and x.any():
                    ids.append(vec_id)
                    dims.append(len(x))
                    data.append(x.tobytes())
                    keys.append(xxhash.xxh3_128_digest(data[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(dims, pa.int32()), pa.array(data, pa.binary())], ["vec_id", "key", "dim", "vec"])

    return own.mapInArrow(run, "vec_id bigint, key binary, dim int, vec binary")


def entries(rows: DataFrame, top: int) -> DataFrame:
    """(key, vec, ids): each distinct vector with its ``top`` + 1 least ids. The limit is applied in the tasks before rows of a vector meet."""
    ids = rows.select("key", "vec_id").distinct()
    place = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    least = ids.withColumn("place", place).where(F.col("place") <= top + 1).groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return rows.groupBy("key").agg(F.min("vec").alias("vec")).join(least, "key")


# Codebooks.


def k_means(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most ``k`` centroids by Lloyd's rounds from randomly drawn points; a centroid that lost its points takes the worst served one."""
    if not points.shape[1]:
        return np.zeros((1, 0))
    rng = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    centroids = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(ROUNDS):
        near, far = nearest(points, centroids)
        count = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, points)
        empty = np.flatnonzero(count == 0)
        sums[empty], count[empty] = points[np.argsort(-far)[: len(empty)]], 1
        centroids = sums / count[:, None]
    return centroids


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each point, and the squared distance to it."""
    distance = (centroids**2).sum(1) - 2 * points @ centroids.T
    near = distance.argmin(1)
    return near, np.maximum(distance[np.arange(len(points)), near] + (points**2).sum(1), 0)


@dataclass(frozen=True)
class Quantiser:
    """Codebooks of both halves."""

    first: np.ndarray
    second: np.ndarray

    @property
    def dim(self) -> int:
        return self.first.shape[1] + self.second.shape[1]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[..., : self.first.shape[1]], x[..., self.first.shape[1] :]

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Both centroids of each vector and the squared residuals of its halves."""
        a, b = self.halves(x)
        (i, ri), (j, rj) = nearest(a, self.first), nearest(b, self.second)
        return i, j, ri, rj


def fit(rows: DataFrame, n: int, sample: int = SAMPLE) -> Quantiser | None:
    """Codebooks from the ``sample`` entries with the least keys, which are hashes; None if there is none."""
    taken = rows.orderBy("key").select("vec").limit(sample).toArrow().column("vec").to_pylist()
    if not taken:
        return None
    dim = Counter(map(len, taken)).most_common(1)[0][0]
    points = np.frombuffer(b"".join(t for t in taken if len(t) == dim)).reshape(-1, dim // 8)
    k = int(min(MOST_CENTROIDS, max(16, round(2 * n**0.25))))
    half = points.shape[1] // 2
    return Quantiser(k_means(points[:, :half], k, 1), k_means(points[:, half:], k, 2))


# Walks.


@dataclass(frozen=True)
class Cells:
    """How many entries each pair of centroids holds, and the mean squared residual of a component by half and centroid."""

    quantiser: Quantiser
    count: np.ndarray
    spread_first: np.ndarray
    spread_second: np.ndarray

    @cached_property
    def per_first(self) -> np.ndarray:
        return self.count.sum(1)

    def expected(self, a: np.ndarray, b: np.ndarray, x: np.ndarray, least: float) -> np.ndarray:
        """In each cell, the rows expected to have a product of ``least`` or more with the query, the sum of whose centroid products is ``a[i] + b[j]``."""
        u, v = self.quantiser.halves(x)
        spread = np.sqrt((u @ u) * self.spread_first[:, None] + (v @ v) * self.spread_second[None, :])
        with np.errstate(divide="ignore", invalid="ignore"):
            away = (least - (a[:, None] + b[None, :])) / spread
        away[np.isnan(away)] = 0
        return self.count * tail(away)

    def walk(self, x: np.ndarray, enough: float, least: float | None = None) -> dict[int, int]:
        """The prefix of second centroids for each first one that the heap has reached when the seen cells suffice.

        Without ``least`` they suffice if they hold ``enough`` entries, with it if no more than ``enough`` rows that reach it are expected in the others.
        """
        u, v = self.quantiser.halves(x)
        a, b = self.quantiser.first @ u, self.quantiser.second @ v
        by_a, by_b = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        if least is None:
            worth, open_ = self.count, enough
        else:
            worth = self.expected(a, b, x, least)
            open_ = worth.sum() - enough
        worth = worth[by_a][:, by_b]
        sums_a, sums_b = a[by_a].tolist(), b[by_b].tolist()
        reached = [0] * len(sums_a)
        heap = [(-(sums_a[0] + sums_b[0]), 0, 0)]
        while heap and open_ > 0:
            _, i, j = heapq.heappop(heap)
            reached[i] = j + 1
            open_ -= worth[i, j]
            if j + 1 < len(sums_b):
                heapq.heappush(heap, (-(sums_a[i] + sums_b[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(sums_a):
                heapq.heappush(heap, (-(sums_a[i + 1] + sums_b[0]), i + 1, 0))
        return {int(by_a[i]): n for i, n in enumerate(reached) if n}


_erfc = np.vectorize(erfc, otypes=[float])
#: The upper tail of the normal distribution at steps of 1/64 from -8 to 8.
_TAIL = _erfc(np.arange(-512, 513) / 64 / 2**0.5) / 2


def tail(z: np.ndarray) -> np.ndarray:
    return _TAIL[np.clip(np.floor(z * 64), -512, 512).astype(np.int64) + 512]


def ordered(quantiser: Quantiser, x: np.ndarray) -> np.ndarray:
    """For each query (row), the place of every second centroid in its order."""
    b = quantiser.halves(x)[1] @ quantiser.second.T
    order = np.argsort(-b, axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], axis=1)
    return place


def vectors_of(data: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(data)).reshape(len(data), -1)


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products, row by row, summed from the first component to the last."""
    return np.add.accumulate(x * y, axis=-1)[..., -1]


def index_of(rows: DataFrame, quantiser: Quantiser) -> DataFrame:
    """Entries with their cell (i, j) and squared residuals; other dimensions are left out."""
    own = rows.where(F.octet_length("vec") == 8 * quantiser.dim)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                i, j, ri, rj = quantiser.cells(vectors_of(column(batch, "vec")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(ri), pa.array(rj)], [*batch.schema.names, "i", "j", "ri", "rj"])

    return own.mapInArrow(run, "key binary, vec binary, ids array<bigint>, i int, j int, ri double, rj double")


def cells_of(index: DataFrame, quantiser: Quantiser) -> Cells:
    """Sums by cell: as many rows at most as there are pairs of centroids."""
    k1, k2 = len(quantiser.first), len(quantiser.second)
    got = index.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"), F.sum("ri").alias("ri"), F.sum("rj").alias("rj")).toArrow()
    i, j, n, ri, rj = (got.column(c).to_numpy() for c in ("i", "j", "n", "ri", "rj"))
    count = np.zeros((k1, k2))
    count[i, j] = n
    first, second = np.bincount(i, ri, k1), np.bincount(j, rj, k2)
    d1, d2 = quantiser.first.shape[1], quantiser.second.shape[1]
    return Cells(quantiser, count, first / np.maximum(count.sum(1), 1) / max(d1, 1), second / np.maximum(count.sum(0), 1) / max(d2, 1))


def walks(queries: DataFrame, cells: Cells, blocks: np.ndarray, first: int, missed: float) -> DataFrame:
    """A row for each query and each block of the first centroids it reaches: (i, block, key, vec, least, after, upto).

    ``after`` and ``upto`` bound the prefix of second centroids: a walk with a ``least`` score leaves out what the one without has seen.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, i, block, after, upto = [], [], [], [], []
            for row, (data, least) in enumerate(zip(column(batch, "vec"), column(batch, "least"), strict=True)):
                x = np.frombuffer(data)
                seen = cells.walk(x, first)
                wanted, seen = (seen, {}) if least is None else (cells.walk(x, missed, least - SLACK), seen)
                for c, n in wanted.items():
                    if n > seen.get(c, 0) and cells.per_first[c]:
                        for b in range(int(blocks[c])):
                            which.append(row)
                            i.append(c)
                            block.append(b)
                            after.append(seen.get(c, 0))
                            upto.append(n)
            own = batch.select(["key", "vec", "least"]).take(pa.array(which, pa.int64()))
            numbers = [pa.array(x, pa.int32()) for x in (i, block, after, upto)]
            yield pa.RecordBatch.from_arrays([*own.columns, *numbers], ["key", "vec", "least", "i", "block", "after", "upto"])

    return queries.select("key", "vec", "least").mapInArrow(run, "key binary, vec binary, least double, i int, block int, after int, upto int")


def found(index: DataFrame, asked: DataFrame, quantiser: Quantiser, top: int) -> DataFrame:
    """(key, found, ids, score): for each query and block its ``top`` + 1 best entries, of those in the walk's cells that reach its least score.

    In each block's rows the entries come first and are kept as a matrix; queries stream past it.
    """
    rows = index.select("i", "block", "j", "key", "vec", "ids").unionByName(asked.withColumn("j", F.lit(-1)), allowMissingColumns=True)
    rows = rows.withColumn("asks", F.col("j") < 0).repartition("i", "block").sortWithinPartitions("i", "block", "asks")

    def scored(block: tuple, part: pa.RecordBatch) -> pa.RecordBatch:
        matrix, seconds, keys, ids = block
        x = vectors_of(column(part, "vec"))
        place = ordered(quantiser, x)[:, seconds]
        near = (place >= np.array(column(part, "after"))[:, None]) & (place < np.array(column(part, "upto"))[:, None])
        least = np.array([-np.inf if v is None else v - SLACK * (1 + abs(v)) for v in column(part, "least")])
        score = np.where(near, x @ matrix.T, -np.inf)
        near &= score >= least[:, None]
        if score.shape[1] > top + 1:  # what the block's best exceed, but for the last places, can't be among the query's best
            least = np.partition(score, -top - 1, axis=1)[:, -top - 1]
            near &= score >= (least - SLACK * (1 + np.abs(np.where(np.isfinite(least), least, 0))))[:, None]
        q, e = np.nonzero(near)
        entries_, queries_ = pa.array(e, pa.int64()), pa.array(q, pa.int64())
        return pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("key")).take(queries_), keys.take(entries_), ids.take(entries_), pa.array(exact(x[q], matrix[e]), pa.float64())], ["key", "found", "ids", "score"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block = None, [], None
        for (i, number, asks), part in parts_of(batches, "i", "block", "asks"):
            if (i, number) != now:
                now, held, block = (i, number), [], None
            if not asks:
                held.append(part)
                continue
            if not held:
                continue
            if block is None:
                matrix = vectors_of([v for h in held for v in column(h, "vec")])
                keys, ids = (pa.concat_arrays([h.column(h.schema.get_field_index(c)) for h in held]) for c in ("key", "ids"))
                block = matrix, np.array([v for h in held for v in column(h, "j")]), keys, ids
            for start in range(0, part.num_rows, TOGETHER):
                yield scored(block, part.slice(start, TOGETHER))

    return rows.mapInArrow(run, "key binary, found binary, ids array<bigint>, score double")


def best(pairs: DataFrame, top: int) -> DataFrame:
    """Each query's ``top`` + 1 best entries."""
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.element_at("ids", 1), "found")
    return pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top + 1)


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", top: int = TOP, recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of every row for whose ``vec_id`` ``is_query`` holds."""
    spark = vectors.sparkSession
    rows = materialize(usable(vectors, id_col, vector_col), "vectors")
    asking = rows.where(is_query).select("key", F.col("vec_id").alias("query_id")).distinct()
    distinct = materialize(entries(rows, top), "entries")
    n = distinct.count()
    quantiser = fit(distinct, n, sample)
    if quantiser is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    index = materialize(index_of(distinct, quantiser), "cells")
    cells = cells_of(index, quantiser)
    blocks = np.maximum(1, -(-cells.per_first // BLOCK)).astype(np.int64)
    number = F.array(*(F.lit(int(b)) for b in blocks))
    index = index.withColumn("block", F.pmod(F.xxhash64("key"), F.get(number, F.col("i"))).cast("int"))
    queries = index.join(asking.select("key").distinct(), "key", "left_semi").select("key", "vec", F.lit(None).cast("double").alias("least"))
    bounds = (blocks, FIRST * top, (1 - recall) * top)
    first = materialize(best(found(index, walks(queries, cells, *bounds), quantiser, top), top), "first")
    # the entry at place top + 1 holds for copies and the query itself; with fewer found, nothing bounds the second walk
    least = first.where(F.col("place") == top + 1).select("key", F.col("score").alias("reached"))
    again = queries.join(least, "key", "left").select("key", "vec", F.coalesce("reached", F.lit(float("-inf"))).alias("least"))
    second = found(index, walks(again, cells, *bounds), quantiser, top)
    near = best(first.drop("place").unionByName(second), top)
    lists = near.groupBy("key").agg(F.collect_list(F.struct("score", "ids")).alias("near"))
    return asking.join(lists, "key").select("query_id", F.posexplode(nearest_ids(top)).alias("rank", "one")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("one.vec_id").alias("vec_id"), F.col("one.score").alias("score"))


def nearest_ids(top: int) -> Column:
    """The ``top`` first of the entries' ids, other than the query's own, by score and id."""
    one = F.flatten(F.transform("near", lambda n: F.transform(n["ids"], lambda i: F.struct((-n["score"]).alias("far"), i.alias("vec_id"), n["score"].alias("score")))))
    return F.slice(F.array_sort(F.filter(one, lambda x: x["vec_id"] != F.col("query_id"))), 1, top)


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose id is divisible by 20, among all others."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


#: All rows against all: what the search gives exactly where its first walk sees every cell, as on the small tables.
OP12_SQL = """
WITH own AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
)
SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id)::INTEGER AS rank, c.vec_id, list_inner_product(q.v, c.v) AS score
FROM own q JOIN own c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0 QUALIFY rank <= 20
"""
