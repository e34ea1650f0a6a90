"""Bounded samples of labelled rows, and the rule statistics that two classifiers learn from."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points that part words, and those that count as symbols. Fixed values of the rules.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
ASCII_UPPER = bytes(range(0x41, 0x5B))
DIGITS = bytes(range(0x30, 0x3A))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, max_rows: int, where: Column | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled ids, chosen by a hash of the id; the sample alone is broadcast.

    Rows without id or label don't count; of several labels of one id the smallest holds, and of several texts the first in order
    that isn't null (one of its rows without a text, if none has one).
    """
    chosen = labels.select(F.col(id_col).alias("doc_id"), F.col(label).alias("label")).dropna()
    if where is not None:
        chosen = chosen.where(where)
    chosen = chosen.groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(max_rows)
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


def repeated_word_count(tokens: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the text, the first included."""
    n = len(tokens)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in tokens), np.int64, n)
    size = len(number)
    if size == n:
        return 0
    first = ids[:-2] * size + ids[1:-1]
    if size > 2_000_000:
        first = np.unique(first, return_inverse=True)[1]
    _, inverse, counts = np.unique(first * size + ids[2:], return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    if not again.any():
        return 0
    hit = np.zeros(n, bool)
    for i in range(3):
        hit[i : n - 2 + i] |= again
    return int(hit.sum())


def rule_statistics(text: str | None) -> tuple[int, int, int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then n_lines, n_upper (A-Z) and n_digits. Null counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    tokens = raw.split()
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(tokens), chars, symbols, len(lines) - len(set(lines)), repeated_word_count(tokens), len(lines),
        len(raw) - len(raw.translate(None, ASCII_UPPER)), len(raw) - len(raw.translate(None, DIGITS)),
    )


def ratios(stats: np.ndarray) -> np.ndarray:
    """Size-free features of ``rule_statistics`` rows: word length, then shares of symbols, repeated lines and words, capitals and digits."""
    s = np.asarray(stats, float).reshape(-1, 8)
    words, chars, lines = (np.maximum(s[:, i], 1) for i in (0, 1, 5))
    return np.column_stack([s[:, 1] / words, s[:, 2] / chars, s[:, 3] / lines, s[:, 4] / words, s[:, 6] / chars, s[:, 7] / chars])
