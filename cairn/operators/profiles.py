"""The most similar rows by two sets of tokens, all held against all, for tokens that so many rows hold that no row is told by them.

Rows with equal tokens and sizes are one profile. Each task asks for its share of the profiles and walks through all of them in chunks, so it holds its share, one
chunk and the best of each profile; nothing is left out but what can't reach the threshold or the best that are known. The walk is quadratic in the distinct profiles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Profiles that are held against each other at once.
ASKED, CHUNK = 256, 2_048


@dataclass
class Sets:
    """Tokens of profiles, title tokens apart from the rest, the sizes of their whole sets and the places of the rows that stand for them."""

    title: tuple[np.ndarray, np.ndarray]
    other: tuple[np.ndarray, np.ndarray]
    n_title: np.ndarray
    n_all: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, rows: pa.RecordBatch, most: int) -> Sets:
        flat = lambda name: (np.repeat(np.arange(rows.num_rows), np.diff(np.asarray(rows[name].offsets))), np.asarray(rows[name].flatten()))
        row, place = flat("places")
        places = np.full((rows.num_rows, most), np.iinfo(np.int64).max)
        places[row, np.arange(len(row)) - np.searchsorted(row, row)] = place
        return cls(flat("title"), flat("other"), np.asarray(rows["n_title"]), np.asarray(rows["n_all"]), places)

    def matrix(self, vocabulary: np.ndarray, *kinds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        out = np.zeros((len(self.n_all), len(vocabulary)), np.float32)
        for row, token in kinds:
            at = np.minimum(np.searchsorted(vocabulary, token), len(vocabulary) - 1)
            there = vocabulary[at] == token
            out[row[there], at[there]] = 1
        return out

    def reach(self) -> tuple[int, int, int, int]:
        """Most tokens that others may share, and least sizes: of titles, of all."""
        title, other = (np.bincount(row, minlength=len(self.n_all)) for row, _ in (self.title, self.other))
        return int(title.max()), int((title + other).max()), int(self.n_title.min()), int(self.n_all.min())


def common(x: Sets, y: Sets) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens each pair shares, of titles and of all."""
    words = np.intersect1d(x.title[1], y.title[1])
    titles = x.matrix(words, x.title) @ y.matrix(words, y.title).T if len(words) else np.zeros((len(x.n_all), len(y.n_all)), np.float32)
    words = np.union1d(x.other[1], y.other[1])  # beyond these, what is shared is shared by titles
    if not len(words):
        return titles, titles
    rest = x.matrix(words, x.title, x.other) @ y.matrix(words, y.title, y.other).T - x.matrix(words, x.title) @ y.matrix(words, y.title).T
    return titles, titles + rest


class Best:
    """The best of all profiles for some that ask: by score, then by the first place."""

    def __init__(self, keys: pa.Array, sets: Sets, most: int, shares: tuple[float, float], threshold: float) -> None:
        self.keys, self.sets, self.most, self.shares, self.threshold, self.reach = keys, sets, most, shares, threshold, sets.reach()
        n = len(keys)
        self.score, self.places = np.full((n, most), -np.inf), np.full((n, most, most), np.iinfo(np.int64).max)

    def see(self, other: Sets, reach: tuple[int, int, int, int]) -> None:
        least = np.maximum(self.score[:, -1], self.threshold)
        shared = [min(a, b) for a, b in zip(self.reach, reach, strict=True)][:2]
        sizes = [max(a, b) for a, b in zip(self.reach[2:], reach[2:], strict=True)]
        if sum(share * min(1.0, k / max(n, 1)) for share, k, n in zip(self.shares, shared, sizes, strict=True)) < least.min() - 1e-9:
            return
        both = list(zip(common(self.sets, other), ("n_title", "n_all"), self.shares, strict=True))
        rough = np.zeros(both[0][0].shape, np.float32)
        for k, name, share in both:
            sum_ = getattr(self.sets, name).astype(np.float32)[:, None] + getattr(other, name).astype(np.float32)
            rough += np.float32(share) * (k / np.maximum(sum_ - k, 1))
        x, y = np.nonzero((rough >= (least - 1e-5).astype(np.float32)[:, None]) & (both[1][0] > 0))
        if not len(x):
            return
        exact = []
        for k, name, share in both:
            k = k[x, y].astype(np.int64)
            exact.append(share * (k / np.maximum(getattr(self.sets, name)[x] + getattr(other, name)[y] - k, 1)))
        score = exact[0] + exact[1]
        first = other.places[y, 0]
        ok = (score >= self.threshold) & ((score > self.score[x, -1]) | ((score == self.score[x, -1]) & (first < self.places[x, -1, 0])))
        x, y, score = x[ok], y[ok], score[ok]
        rows = np.unique(x)
        row = np.r_[np.repeat(rows, self.most), x]
        score, places = np.r_[self.score[rows].ravel(), score], np.concatenate([self.places[rows].reshape(-1, self.most), other.places[y]])
        order = np.lexsort((places[:, 0], -score, row))
        row = row[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        kept = nth < self.most
        self.score[row[kept], nth[kept]], self.places[row[kept], nth[kept]] = score[order[kept]], places[order[kept]]

    def rows(self) -> pa.RecordBatch:
        """(key, place, score) of the first ``most`` rows of each that asks."""
        n = len(self.keys)
        place = self.places.reshape(n, -1)
        score = np.where(place < np.iinfo(np.int64).max, np.repeat(self.score, self.most, 1), -np.inf)
        order = np.lexsort((place, -score), axis=1)[:, : self.most]
        score, place = np.take_along_axis(score, order, 1), np.take_along_axis(place, order, 1)
        row, at = np.nonzero(score > -np.inf)
        return pa.RecordBatch.from_arrays([self.keys.take(pa.array(row)), pa.array(place[row, at]), pa.array(score[row, at])], ["key", "place", "score"])


def nearest(profiles: DataFrame, most: int, shares: tuple[float, float], threshold: float) -> DataFrame:
    """(key, place, score): the first ``most`` rows for each profile by descending score, then place, of those that share a token and reach the threshold.

    profiles: a stored table of key, lead (what profiles are ordered by, so that chunks hold similar ones), title, other (tokens as numbers), n_title, n_all and
    places, the first ``most`` rows of the profile in order.
    """
    tasks = int(profiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["key", "title", "other", "n_title", "n_all", "places"]
    asked = profiles.select(F.pmod(F.xxhash64("key"), F.lit(tasks)).cast("int").alias("i"), F.lit(0).alias("kind"), "lead", *columns)
    every = profiles.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("i"), F.lit(1).alias("kind"), "lead", *columns)
    dealt = asked.unionAll(every).repartitionByRange(tasks, "i").sortWithinPartitions("i", "kind", "lead", "n_all")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[Best] = []
        part = -1
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                i, kind = (np.asarray(batch[name])[start:] for name in ("i", "kind"))
                size = int(np.argmax(np.r_[(i != i[0]) | (kind != kind[0]), True]))
                if i[0] != part:
                    yield from (b.rows() for b in best)
                    best, part = [], i[0]
                rows = batch.slice(start, min(size, CHUNK if kind[0] else ASKED))
                # slices keep the offsets of the whole, so rows are taken
                rows = rows.take(pa.array(np.arange(rows.num_rows)))
                sets = Sets.of(rows, most)
                if kind[0] == 0:
                    best.append(Best(rows["key"], sets, most, shares, threshold))
                elif best:
                    reach = sets.reach()
                    for b in best:
                        b.see(sets, reach)
                start += rows.num_rows
        yield from (b.rows() for b in best)

    return dealt.mapInArrow(run, "key string, place bigint, score double")
