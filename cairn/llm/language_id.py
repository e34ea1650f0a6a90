"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors of hashed character n-grams (one to three bytes of lower-cased UTF-8).
Each language has several centroids, found by spherical k-means over a bounded labelled sample; a text gets
the language of the centroid with the largest cosine. Texts further from their centroid than the training
texts are (``rejected``) belong to none of the learned languages well.

Null texts and texts without a letter get ``und`` and score 0. Rows with a null language aren't learnt from.
Ties go to the language first in order. Without any labelled row all predictions are ``und``. Repeated rows get equal
results, and a text that many rows share is learnt from once. Very long texts are counted whole, piece by piece. An empty table gives an
empty result. Only the columns named as parameters are read, so further ones may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.llm.common import column, held_out, rows_of, table
from cairn.scratch import broadcast_if

DIMENSIONS = 4096
UNKNOWN = "und"


def counts(text: str) -> np.ndarray:
    """Hashed counts of n-grams over letters, marks and single spaces; long texts are counted piece by piece."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    raw = np.where((raw < 0x61) | ((raw > 0x7A) & (raw < 0x80)), 0x20, raw)
    out = np.zeros(DIMENSIONS, np.int64)
    for start in range(0, len(raw), 1 << 20):
        a = raw[max(0, start - 2) : start + (1 << 20)].astype(np.uint32)
        a = a[np.r_[True, (a[1:] != 0x20) | (a[:-1] != 0x20)]]
        two, three = a[:-1] * 0x101 + a[1:], a[:-2] * 0x10101 + a[1:-1] * 0x101 + a[2:]
        for n, g in ((1, a), (2, two), (3, three)):
            out += np.bincount(((g + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMENSIONS)
    return out


def packed(n: np.ndarray) -> bytes:
    """Counts in two bytes each if the largest fits, else in eight."""
    return n.astype(np.uint16 if n.max() < 2**16 else np.int64).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint16 if len(data) == 2 * DIMENSIONS else np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Centroids:
    languages: list[str] = field(default_factory=list)
    owner: np.ndarray = field(default_factory=lambda: np.zeros(0, int))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMENSIONS), np.float32))
    radius: np.ndarray = field(default_factory=lambda: np.zeros(0))
    idf: np.ndarray = field(default_factory=lambda: np.ones(DIMENSIONS, np.float32))

    def embed(self, tf: np.ndarray) -> np.ndarray:
        x = np.log1p(tf).astype(np.float32) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def nearest(self, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cosine = self.embed(tf) @ self.vectors.T
        best = cosine.argmax(1)
        return best, np.clip(cosine[np.arange(len(tf)), best], 0, 1)


def clustered(x: np.ndarray, k: int, steps: int = 12) -> np.ndarray:
    """Spherical k-means, started from rows far apart."""
    centres = [x.mean(0)]
    while len(centres) < min(k, len(x)):
        centres.append(x[(x @ np.array(centres).T).max(1).argmin()])
    c = np.array(centres)
    for _ in range(steps):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
        own = (x @ c.T).argmax(1)
        c = np.array([x[own == i].mean(0) if (own == i).any() else c[i] for i in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)


def train(tf: np.ndarray, langs: list[str], per_language: int = 4, slack: float = 0.1) -> Centroids:
    if not len(langs):
        return Centroids()
    df = (tf > 0).sum(0)
    model = Centroids(sorted(set(langs)), idf=np.log((1 + len(tf)) / (1 + df)).astype(np.float32) + 1)
    x, y = model.embed(tf), np.array(langs)
    sets = [clustered(x[y == name], per_language) for name in model.languages]
    model.vectors = np.vstack(sets).astype(np.float32)
    model.owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    best, cosine = model.nearest(tf)
    model.radius = np.array([np.min(cosine[best == i], initial=1.0) - slack for i in range(len(model.owner))])
    return model


def fit(docs: DataFrame, max_rows: int = 2_000, where: Column | None = None, text_col: str = "text", lang_col: str = "lang") -> Centroids:
    """Learn from about ``max_rows`` labelled texts, as many of each language, and one at least of every language; only their n-gram counts reach the driver.

    Of a language those distinct texts are drawn whose hashes are least, so one whose rows are nearly all copies is learnt from what texts it has.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if where is not None:
        known = known.where(where)
    known = known.select(F.col(lang_col).alias("lang"), F.xxhash64(F.lit("sample"), text_col).alias("draw"), F.col(text_col).alias("text"))
    draws = known.select("lang", "draw").distinct()
    languages = draws.select("lang").distinct().count()
    if not languages:
        return Centroids()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    drawn = draws.withColumn("place", place).where(F.col("place") <= max(1, max_rows // languages)).drop("place")
    sample = known.join(broadcast_if(drawn, 20_000), ["lang", "draw"]).dropDuplicates(["lang", "draw"]).select("lang", "text")

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rows_of(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(column(part, "lang"), pa.string()), pa.array([packed(counts(t)) for t in texts], pa.binary())], ["lang", "tf"])

    got = sample.mapInArrow(vectors, "lang string, tf binary").toArrow()
    rows = sorted(zip(got["lang"].to_pylist(), got["tf"].to_pylist(), strict=True))
    tf = np.array([unpacked(v) for _, v in rows], np.float32).reshape(-1, DIMENSIONS)
    return train(tf, [name for name, _ in rows])


def predict(docs: DataFrame, model: Centroids, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score (cosine), rejected."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rows_of(batches, "text", 128):
            lettered = np.array([has_letter(t) for t in texts]) & bool(len(model.vectors))
            names, scores, far = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            if (at := np.flatnonzero(lettered)).size:
                best, cosine = model.nearest(np.array([counts(texts[i]) for i in at]))
                scores[at], far[at] = cosine, cosine < model.radius[best]
                for i, b in zip(at, best, strict=True):
                    names[i] = model.languages[model.owner[b]]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores), pa.array(far)], ["doc_id", "lang_pred", "score", "rejected"])

    own = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    apart = held_out(F.col("doc_id"), 4, 2)
    model = fit(docs, where=~apart)
    return predict(docs, model).select("doc_id", apart.alias("held_out"), "lang_pred", "score", "rejected")
