"""Quality rules: an isolation forest over rule statistics, its threshold calibrated on labelled rows.

Each document's rule statistics (``training.rule_statistics``) go down trees of random splits; documents
that few splits isolate are anomalous. As the method has it, each tree is grown on rows of its own, ``DRAWN`` of all
labelled ones, in which the bad ones are thinned to a fiftieth, as rare as anomalies are (without any, splits would never leave the range of good
rows); the threshold is the lowest that keeps all but ``max_loss`` of all labelled good rows, which are scored and counted where they are.
Of several labels of one id the smallest holds, of several texts that of the least statistics, one that isn't null before null.
The forest sees word length and the shares of symbols and capitals. Repeated words are judged by the base rules; repeated lines
decide nothing, as good rows have them as often as bad ones (README).

Null and empty texts have no words and fail the base rules. Repeated rows each get their own, equal, result.
Without labelled rows no threshold can be set, and the base rules alone decide. A score that equals the threshold is anomalous; equal
statistics make equal scores. Very long texts are measured whole. An empty table gives an empty result, and further columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.llm.common import column, materialize, mix, rows_of, table
from cairn.llm.training import ratios, rule_statistics

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: All that is measured of a text, as ``rule_statistics`` gives it.
MEASURED = (*STATS, "n_lines", "n_upper", "n_digits")
TREES, DRAWN = 128, 256
#: Into so many parts the range of scores is divided in each round of the search for the threshold.
PARTS = 1_024


@dataclass
class Forest:
    """One row a tree: node arrays in heap order; a leaf has feature -1 and the depth that its rows count as."""

    feature: np.ndarray
    split: np.ndarray
    depth: np.ndarray
    norm: float
    threshold: float = 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score of each row, 0 to 1."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, split, depth in zip(self.feature, self.split, self.depth, strict=True):
            node = np.zeros(len(x), int)
            inner = feature[node] >= 0
            while inner.any():
                at = rows[inner]
                f = feature[node[at]]
                node[at] = 2 * node[at] + 1 + (x[at, f] >= split[node[at]])
                inner = feature[node] >= 0
            total += depth[node]
        return 2.0 ** (-total / len(self.feature) / self.norm)


def expected_depth(n: int) -> float:
    """Mean depth of an unsuccessful search in a random binary tree of n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grown(drawn: list[np.ndarray], seed: int = 7) -> Forest:
    """A forest of one tree for each matrix of rows."""
    rng = np.random.default_rng(seed)
    most = max(map(len, drawn))
    levels = max(1, math.ceil(math.log2(max(2, most))))
    nodes, trees, columns = 2 ** (levels + 1) - 1, len(drawn), drawn[0].shape[1]
    feature, split, depth = np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        todo = [(0, 0, drawn[t])]
        while todo:
            node, level, rows = todo.pop()
            low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(columns),) * 2
            open_ = np.flatnonzero(high > low)
            if level == levels or len(rows) < 2 or not len(open_):
                depth[t, node] = level + expected_depth(len(rows))
                continue
            f = rng.choice(open_)
            at = rng.uniform(low[f], high[f])
            at = at if at > low[f] else high[f]
            feature[t, node], split[t, node] = f, at
            right = rows[:, f] >= at
            todo += [(2 * node + 1, level + 1, rows[~right]), (2 * node + 2, level + 1, rows[right])]
    return Forest(feature, split, depth, expected_depth(most) or 1.0)


def grow(x: np.ndarray, trees: int = TREES, sample: int = DRAWN, seed: int = 7) -> Forest:
    rng = np.random.default_rng(seed)
    return grown([x[rng.choice(len(x), min(sample, len(x)), replace=False)] for _ in range(trees)], seed)


def drawn(rows: DataFrame, trees: int = TREES, sample: int = DRAWN) -> list[np.ndarray]:
    """For each tree ``sample`` of the rows (h, features), those of the least hashes of tree and ``h``: each task hands on its own, these alone reach the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.asarray(batch["h"]).view(np.uint64)
            for t in range(trees):
                race = mix(h, 1001 + t)
                own = np.argpartition(race, sample)[:sample] if len(race) > sample else np.arange(len(race))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), t)), pa.array(race[own].view(np.int64)), batch["x"].take(pa.array(own))], ["tree", "race", "x"])

    each = rows.select("h", "x").mapInArrow(run, "tree bigint, race bigint, x array<double>")
    first = each.withColumn("at", F.row_number().over(Window.partitionBy("tree").orderBy("race", "x"))).where(F.col("at") <= sample)
    got = first.select("tree", "at", "x").toArrow().sort_by([("tree", "ascending"), ("at", "ascending")])
    tree, x = np.asarray(got["tree"]), np.array(got["x"].to_pylist(), float).reshape(len(got), -1)
    return [x[tree == t] for t in range(trees)]


def nth_greatest(rows: DataFrame, n: int) -> float:
    """The n-th greatest ``score``, counting from 0 and equal ones each: parts of the range are counted, then those of the part that holds it, until it has one value."""
    low, high = rows.agg(F.min("score"), F.max("score")).first()
    while low < high:
        part = F.least(F.floor((F.col("score") - low) / (high - low) * PARTS), F.lit(PARTS - 1))
        part = F.when(F.col("score") == high, PARTS).otherwise(part)
        counts = rows.where(F.col("score").between(low, high)).groupBy(part.alias("part")).agg(F.count(F.lit(1)), F.min("score"), F.max("score")).collect()
        for _, count, low, high in sorted(counts, reverse=True):  # noqa: B007
            if n < count:
                break
            n -= count
    return low


def form(stats: np.ndarray) -> np.ndarray:
    """Word length, share of symbols, share of capitals."""
    return ratios(stats)[:, [0, 1, 4]]


def base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, whether it has a text, and MEASURED."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rows_of(batches, "text"):
            if texts:
                stats = np.array([rule_statistics(t) for t in texts], np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part["text"].is_valid(), *(pa.array(stats[:, i]) for i in range(len(MEASURED)))], ["doc_id", "is_text", *MEASURED])

    own = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, is_text boolean, " + ", ".join(f"{c} bigint" for c in MEASURED))


def stats_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([np.asarray(batch[c]) for c in MEASURED], np.int64).T


def learnt(rows: DataFrame, labels: DataFrame, max_loss: float = 0.004, where: Column | None = None) -> Forest | None:
    """Grow and calibrate on what ``measured`` gives of all labelled rows."""
    chosen = labels.select("doc_id", F.col("quality").alias("label")).dropna()
    chosen = (chosen if where is None else chosen.where(where)).groupBy("doc_id").agg(F.min("label").alias("label"))
    one = rows.join(chosen, "doc_id").groupBy("doc_id").agg(F.min(F.struct((~F.col("is_text")).alias("none"), *MEASURED)).alias("s"), F.first("label").alias("label"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    free = one.select(F.xxhash64("doc_id").alias("h"), (F.col("label") == 1).alias("good"), *(F.col("s")[c].alias(c) for c in MEASURED)).where(~failed)

    def formed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array(form(stats_of(batch)).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["h"], batch["good"], x], ["h", "good", "x"])

    own = materialize(free.mapInArrow(formed, "h bigint, good boolean, x array<double>"), "labelled")
    n, good = own.agg(F.count(F.lit(1)), F.count_if("good")).first()
    if not good:
        return None
    step = max(1, 50 * (n - good) // n)
    forest = grown(drawn(own.where(F.col("good") | (F.pmod(F.xxhash64(F.lit("few"), "h"), F.lit(step)) == 0))))

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch["x"].flatten()).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([pa.array(forest.score(x))], ["score"])

    scores = materialize(own.where("good").mapInArrow(scored, "score double"), "scores")
    forest.threshold = float(np.nextafter(nth_greatest(scores, int(max_loss * good)), 2.0))
    return forest


def fit(docs: DataFrame, labels: DataFrame, max_loss: float = 0.004, where: Column | None = None) -> Forest | None:
    """Grow and calibrate on all labelled rows; only the rows that trees draw reach the driver."""
    return learnt(measured(docs), labels, max_loss, where)


def judged(rows: DataFrame, forest: Forest | None) -> DataFrame:
    """One row for each that ``measured`` gives: the statistics, the base verdict, the anomaly score and whether the document is kept."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = stats_of(batch)
            failed = base_failed(stats[:, 0], stats[:, 4])
            score = forest.score(form(stats)) if forest else np.zeros(len(stats))
            kept = ~failed & (score < (forest.threshold if forest else 2.0))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(batch[c] for c in STATS), pa.array(failed), pa.array(kept), pa.array(score)], ["doc_id", *STATS, "base_failed", "kept", "anomaly_score"])

    fields = ", ".join(f"{c} bigint" for c in STATS)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {fields}, base_failed boolean, kept boolean, anomaly_score double")


def assess(docs: DataFrame, forest: Forest | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the statistics, the base verdict, the anomaly score and whether the document is kept."""
    return judged(measured(docs, id_col, text_col), forest)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(measured(table(spark, sf_dir, "documents")), "measured")
    return judged(rows, learnt(rows, table(spark, sf_dir, "labels")))
