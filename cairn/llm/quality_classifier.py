"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting of shallow trees learns, for each feature in turn, a lookup table over its bins; then the pairs
of features whose cells still explain most of the gradient get tables of their own. A score is the logistic of a
sum of table entries, so scoring is binning and addition over whole columns.

Features come from the text alone. Null texts count as empty; empty texts get a score like all others.
Repeated rows get equal scores. Without labelled rows every score is 0.5. A score that equals the threshold is kept. Values that equal a cut
point fall into the bin above it. Very long texts are measured whole. An empty table gives an empty result, and further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import column, held_out, rows_of, table
from cairn.llm.training import labelled_sample, ratios, rule_statistics

BINS, COARSE = 32, 8


def features(text: str | None) -> list[float]:
    """Rule statistics and a few further counts of one text."""
    text = text or ""
    tokens = text.split()
    n = max(1, len(tokens))
    return [
        *rule_statistics(text),
        text.count("!") / n,
        text.count("|") / n,
        sum(map(text.count, ".,;:?")) / n,
        len(set(tokens)) / n,
        max(map(len, tokens), default=0),
        text.count("\n") / n,
        sum(map(text.count, "***$$$###%%%&&&")) / n,
        len(text) - len(text.encode("ascii", "ignore")),
    ]


def matrix(rows: list[list[float]]) -> np.ndarray:
    x = np.array(rows, float).reshape(-1, 16)
    own = x[:, 8:].copy()
    own[:, -1] /= np.maximum(x[:, 1], 1)
    size = np.column_stack([np.log1p(x[:, 0]), x[:, 0] / np.maximum(x[:, 5], 1)])
    return np.hstack([ratios(x[:, :8]), size, own])


@dataclass
class Additive:
    """Cut points and a lookup table for each feature, and tables over coarse bins for pairs of features."""

    cuts: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            out += t[np.searchsorted(self.cuts[f], x[:, f], "right")]
        for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Value for each bin of a tree over ordered bins, split best-first into ``leaves`` runs."""
    runs = [(0, len(g))]
    while len(runs) < leaves:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(runs):
            if b - a < 2:
                continue
            gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            gs, hs = g[a:b].sum(), h[a:b].sum()
            gains = gain(gl, hl) + gain(gs - gl, hs - hl) - gain(gs, hs)
            if gains.max() > best[0]:
                best = (gains.max(), k, a + int(gains.argmax()) + 1)
        if best[1] is None:
            break
        a, b = runs[best[1]]
        runs[best[1] : best[1] + 1] = [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in runs:
        out[a:b] = leaf(g[a:b].sum(), h[a:b].sum())
    return out


def quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a grid of cells into four parts: its gain, and the value for each cell."""
    gc, hc = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)

    def parts(c: np.ndarray) -> list[np.ndarray]:
        inner = c[:-1, :-1]
        left, top = c[:-1, -1:] - inner, c[-1:, :-1] - inner
        return [inner, left, top, c[-1, -1] - inner - left - top]

    gp, hp = parts(gc), parts(hc)
    gains = sum(gain(a, b) for a, b in zip(gp, hp, strict=True)) - gain(gc[-1, -1], hc[-1, -1])
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    out, v = np.zeros_like(g), [leaf(a[i, j], b[i, j]) for a, b in zip(gp, hp, strict=True)]
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
    return float(gains[i, j]), out


def train(x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 40, pairs: int = 8, rate: float = 0.15) -> Additive:
    model = Additive()
    if not len(x):
        return model
    share = np.clip(y.mean(), 0.01, 0.99)
    model.base = float(np.log(share / (1 - share)))
    model.cuts = [cut_points(x[:, f], BINS) for f in range(x.shape[1])]
    model.coarse = [cut_points(x[:, f], COARSE) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(model.cuts)]
    margin = np.full(len(x), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, own in enumerate(bins):
            g, h = slopes()
            size = len(model.tables[f])
            step = rate * shallow_tree(np.bincount(own, g, size), np.bincount(own, h, size))
            model.tables[f] += step
            margin += step[own]
    coarse = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(model.coarse)]
    shape = [len(c) + 1 for c in model.coarse]

    def cells(a: int, b: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[a] * shape[b] + coarse[b], v, shape[a] * shape[b]).reshape(shape[a], shape[b])

    g, h = slopes()
    ranked = sorted(((quadrants(cells(a, b, g), cells(a, b, h))[0], a, b) for a, b in combinations(range(x.shape[1]), 2)), reverse=True)
    model.pairs = [(a, b) for won, a, b in ranked[:pairs] if won > 0]
    model.pair_tables = [np.zeros((shape[a], shape[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            g, h = slopes()
            step = rate * quadrants(cells(a, b, g), cells(a, b, h))[1]
            model.pair_tables[k] += step
            margin += step[coarse[a], coarse[b]]
    return model


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, where: Column | None = None) -> Additive:
    """Learn from at most ``max_rows`` labelled rows; only their features reach the driver."""
    sample = labelled_sample(docs, labels, "quality", max_rows, where)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rows_of(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(column(part, "label"), pa.int32()), pa.array([features(t) for t in texts], pa.list_(pa.float64()))], ["label", "x"]
            )

    got = sample.mapInArrow(measure, "label int, x array<double>").toArrow()
    rows = sorted(zip(got["x"].to_pylist(), got["label"].to_pylist(), strict=True))
    return train(matrix([x for x, _ in rows]), np.array([float(q == 1) for _, q in rows]))


def score(docs: DataFrame, model: Additive, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, score, predicted."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rows_of(batches, "text"):
            got = model.score(matrix([features(t) for t in texts]))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got), pa.array((got >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    own = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def keep_good(docs: DataFrame, model: Additive, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, whose score reaches the threshold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rows_of(batches, text_col):
            yield part.filter(pa.array(model.score(matrix([features(t) for t in texts])) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def training_rows() -> Column:
    """Labels are learnt from ids whose crc32 leaves a remainder other than 0 modulo 5."""
    return ~held_out(F.col("doc_id"), 5, 0)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), where=training_rows())
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")
