"""BPE encoding by backtracking, and decoding by an offset table.

For each word an Aho-Corasick automaton over the vocabulary finds the longest token at every position. The encoder
takes the longest token, checks it against its left neighbour in a pair-compatibility table (would merging the two
tokens' text, in order of merge rank, have left exactly these two?), falls back to the next shorter prefix that is
a token, and steps back where none fits. Each position is given up at most once, so the work is linear in the word,
and the result is that of applying the merges in order. Tokens are never trained here: the file's path is a parameter.

Null texts encode to nothing, as empty ones do. Repeated rows get equal results, empty tables empty ones. Very long texts are
encoded whole. Columns of the input that are called like the results give way; others may have any name. The tokenizer's file is read by the driver and
sent to the tasks, which need no such file.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.common import rows_of, table

#: Stands for the suffix that marks a word's end; no byte maps to it.
END = "\x01"
#: White space as Unicode defines it.
CONTROLS = regex.compile("[\\x1c-\\x1f]")  # Python parts words at these, Unicode doesn't
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_alphabet() -> dict[int, str]:
    """Printable Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class NewLetter(Exception):
    """A word holds a code point newer than Python's Unicode tables."""


@cache
def new_letters() -> frozenset[str]:
    """Code points that ``regex`` takes for letters or numbers, and Python's Unicode tables don't know."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    return frozenset(c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")


#: Letters of Unicode 16, which the library's patterns know already, and lower case of the capitals of Unicode 16 and 17.
LETTERS_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}


class Bpe:
    """Encoder and decoder for a vocabulary file with word ends, lower case and byte-level words."""

    CACHED = 120_000

    def __init__(self, file: str | bytes) -> None:
        spec = json.loads(file if isinstance(file, bytes) else Path(file).read_bytes())
        model = spec["model"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]], [x["type"] for x in spec["pre_tokenizer"]["pretokenizers"]]
        if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) or spec["decoder"] or model["end_of_word_suffix"] != "</w>":
            raise ValueError("this kind of tokenizer file isn't supported")
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that strip, or match normalised text, aren't supported")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern.replace("[^\\s", f"[^{WHITE}"), regex.V0).findall
        newest = [c for c in sorted(new_letters()) if not any(a <= ord(c) <= b for a, b in LETTERS_16)]
        new = f"[{''.join(map(regex.escape, newest))}]"
        self.new, self.blank = new_letters(), regex.compile(f"[{WHITE}]+")
        old = pattern.replace("[^\\s\\p{L}\\p{N}]", f"(?:[^{WHITE}\\p{{L}}\\p{{N}}]|{new})").replace("[\\p{L}]", f"(?:(?!{new})\\p{{L}})").replace("[\\p{N}]", f"(?:(?!{new})\\p{{N}})")
        self.old_pieces = regex.compile(old, regex.V0).findall
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else None
        self.alphabet = {k: v for k, v in byte_alphabet().items()}

        inner = lambda s: s[:-4] + END if s.endswith("</w>") else s
        self.ids = {inner(t): i for t, i in model["vocab"].items()}
        self.text = {i: t for t, i in self.ids.items()}
        self.pair: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = dict.fromkeys(self.text, -1)
        for rank, (a, b) in enumerate(model["merges"]):
            left, right = self.ids[inner(a)], self.ids[inner(b)]
            whole = self.ids[inner(a + b)]
            if whole in self.parts:
                raise ValueError("a token that two merges make isn't supported")
            self.pair[left, right] = self.rank[whole] = rank
            self.parts[whole] = left, right
        self.automaton = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        self.shorter: dict[int, int | None] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}
        self.spelt: dict[str, bytes] = {}

        shown = {i: t for t, i in (model["vocab"] | self.added).items()}
        pieces = [(" " + shown.get(i, "")).encode() for i in range(max(shown) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        self.pool = np.frombuffer(b"".join(pieces), np.uint8)

    def fits(self, left: int, right: int) -> bool:
        """Entry of the pair-compatibility table: whether merging in order leaves the border between two tokens."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) > 1_000_000:
                self.compatible.clear()
            known = self.compatible[left, right] = self._border_stays(left, right)
        return known

    def _border_stays(self, left: int, right: int) -> bool:
        """Undo merges beside the border from the latest on; at each step no merge across it may come before the one undone last.

        Of the two neighbours the one merged later is undone. Merges of equal text run from left to right, so
        one that touches the border from the left precedes an equal one across it, which precedes one from the right.
        """
        limit = float("inf")
        while True:
            across = self.pair.get((left, right))
            if across is not None and across < limit:
                return False
            a, b = self.rank[left], self.rank[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, self.parts[left][1]
            else:
                limit, right = b + 0.5, self.parts[right][0]

    def prefix(self, token: int) -> int | None:
        """The longest token that is a proper prefix of a token."""
        if token not in self.shorter:
            t = self.text[token]
            self.shorter[token] = next((self.ids[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.ids), None)
        return self.shorter[token]

    def word(self, symbols: str) -> list[int]:
        """Tokens of one word, given in the byte alphabet with its end mark."""
        whole = self.ids.get(symbols)
        if whole is not None:
            return [whole]
        n = len(symbols)
        longest: list[int | None] = [None] * (n + 1)
        for end, (token, size) in self.automaton.iter(symbols):
            longest[end - size + 1] = token
        open_ = bytearray(b"\x01" * (n + 1))
        open_[n - 1] = 0  # the end mark never stands alone
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            last = out[-1] if out else None
            while token is not None:
                end = at + len(self.text[token])
                if open_[end] and (last is None or self.fits(last, token)):
                    break
                token = self.prefix(token)
            if token is not None:
                out.append(token)
                at, token = end, longest[end]
                continue
            open_[at] = 0
            if last is None:
                raise ValueError("the vocabulary can't spell this word")
            out.pop()
            at, token = at - len(self.text[last]), last
        return out

    def spelled(self, piece: str) -> bytes:
        ids = self.spelt.get(piece)
        if ids is None:
            symbols = piece.encode("utf-8", "replace").decode("latin-1").translate(self.alphabet) + END
            ids = array("i", self.word(symbols)).tobytes()
            if len(piece) <= 64:
                if len(self.spelt) >= self.CACHED:
                    self.spelt.clear()
                self.spelt[piece] = ids
        return ids

    def chunk(self, chunk: str) -> bytes:
        """Tokens of text without white space, kept for the next time unless it is long."""
        if not chunk.isascii() and not self.new.isdisjoint(chunk):
            raise NewLetter
        ids = b"".join([self.spelled(p) for p in self.pieces(chunk)])
        if len(chunk) <= 64:
            if len(self.words) >= self.CACHED:
                self.words.clear()
            self.words[chunk] = ids
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        out: list[bytes] = []
        get = self.words.get
        for k, part in enumerate(self.split_added(text or "") if self.split_added else [text or ""]):
            if k % 2:
                out.append(np.array([self.added[part]], np.int32).tobytes())
            elif part:
                clean = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()  # sigma: each letter by itself
                try:
                    chunks = clean.split() if not CONTROLS.search(clean) else self.blank.split(clean)
                    out += [get(c) or self.chunk(c) for c in chunks]
                except NewLetter:
                    out += [self.spelled(p) for p in self.old_pieces(clean.translate(NEW_LOWER))]
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """Tokens joined by one space, gathered from one pool of bytes by an offset table."""
        if not len(ids):
            return b""
        start = self.offsets[ids]
        size = self.offsets[ids + 1] - start
        ends = np.cumsum(size)
        return self.pool[np.repeat(start - ends + size, size) + np.arange(ends[-1])][1:].tobytes()


@cache
def loaded(content: bytes) -> Bpe:
    return Bpe(content)


def shared(spark: SparkSession, path: str | None):  # noqa: ANN201
    """The tokenizer's file, of a few megabytes whatever the corpus, as a broadcast."""
    return spark.sparkContext.broadcast(Path(path or default_path()).read_bytes())


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text", ids: str = "token_ids", decoded: str | None = None) -> DataFrame:
    """The documents with the token ids of each whole text and, if a name is given for it, the text that these decode to.

    Columns of the input with the same names give way.
    """
    file = shared(docs.sparkSession, path)
    own = docs.select(*(docs[c] for c in docs.columns if c not in (ids, decoded)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(file.value)
        for part, texts in rows_of(batches, text_col, 64):
            got = [bpe.encode(t) for t in texts]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in got])]), pa.int32())
            columns = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*got, np.zeros(0, np.int32)])))]
            if decoded:
                columns.append(pa.array([bpe.decode(x).decode("utf-8") for x in got], pa.string()))
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, ids, *[decoded] * bool(decoded)])

    schema = T.StructType([*own.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return own.mapInArrow(run, schema.add(decoded, T.StringType()) if decoded else schema)


def decode(tokens: DataFrame, path: str | None = None, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """The rows with the text that their token ids decode to; null ids decode to an empty text."""
    file = shared(tokens.sparkSession, path)
    own = tokens.select(*(tokens[c] for c in tokens.columns if c != decoded))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(file.value)
        for part, lists in rows_of(batches, ids, 64):
            yield part.append_column(decoded, pa.array([bpe.decode(np.array(x or [], np.int64)).decode("utf-8") for x in lists], pa.string()))

    return own.mapInArrow(run, T.StructType([*own.schema.fields, T.StructField(decoded, T.StringType())]))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, decoded="decoded").select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
