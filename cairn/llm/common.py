"""What several operators share: scratch tables, word splitting, hashing and bounded training samples."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.scratch import materialize, scratch_dir, scratch_path

__all__ = ["WordHash", "column", "free_name", "held_out", "materialize", "mix", "rows_of", "runs_of", "scratch_dir", "scratch_path", "shingles", "table", "text_key", "words"]

#: Bytes outside [0-9a-z] and below 0x80 part words; A-Z become a-z. A UTF-8 byte of 0x80 or more always belongs to a word.
WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words(text: str) -> list[bytes]:
    """Lower-cased words of a text, as UTF-8."""
    return text.encode("utf-8", "replace").translate(WORD_BYTES).split()


class WordHash(dict):
    """Word to 64-bit hash, each word hashed once; emptied when it holds too many words."""

    LIMIT = 250_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, items: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, items), np.uint64, len(items))


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift) of each value, another function for each seed."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Hashes of all runs of ``width`` words; a shorter, non-empty text is one run."""
    n = len(hashes)
    if n == 0:
        return hashes
    w = min(width, n)
    mixed, out = mix(hashes, 0), np.zeros(n - w + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(w):
            out = out * np.uint64(0x9E3779B97F4A7C15) + mixed[i : n - w + 1 + i]
        return mix(out, w)


def free_name(taken: list[str], name: str) -> str:
    """The name, with underscores put before it until no column is called that, whatever its case."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name = f"_{name}"
    return name


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null stays null."""
    return F.when(text.isNotNull(), F.unhex(F.substring(F.sha2(text, 256), 1, 32)))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves that remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def rows_of(batches: Iterable[pa.RecordBatch], name: str, at_most: int = 256) -> Iterable[tuple[pa.RecordBatch, list]]:
    """Slices of the batches with one column as a list, so that long texts never pile up as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, at_most):
            part = batch.slice(start, at_most)
            yield part, column(part, name)


def runs_of(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterable[tuple[tuple, list[pa.RecordBatch]]]:
    """Rows of a sorted partition, run by run of equal keys: the keys' values and the batches of that run, which are held until it ends."""
    held: list[pa.RecordBatch] = []
    for key, part in parts_of(batches, *keys):
        if held and key != now:
            yield now, held
            held = []
        now = key
        held.append(part)
    if held:
        yield now, held


def parts_of(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterable[tuple[tuple, pa.RecordBatch]]:
    """Slices of the batches of a sorted partition whose rows have equal keys, with the keys' values. A run may come in several slices."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        edge = np.zeros(n, bool)
        edge[0] = True
        columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        for c in columns:
            codes = c.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            edge[1:] |= codes[1:] != codes[:-1]
        begins = np.flatnonzero(edge)
        for a, b in zip(begins.tolist(), [*begins[1:].tolist(), n], strict=True):
            yield tuple(c[a].as_py() for c in columns), batch.slice(a, b - a)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
