"""Benchmark decontamination by a distributed positional inverted index.

The index is a table of segments. Each segment holds the postings of some documents: for every word, the sorted
positions at which it occurs, counted through the segment with a gap after each document; and one row for each
document with its first position and length. Segments hold about as many words each, so no word and no source
makes one larger than another, and building needs no shuffle.

A phrase is looked up from its rarest word in the segment: that word's positions, less its offset in the phrase,
are intersected with the positions of the next rarest, and so on. Only postings of words that the test items hold
are read, and only those travel to the task that handles their segment. Test items are handled in blocks of a
bounded number of words.

Null texts have no words: such documents are clean, and such items match nothing. An item without an id is
skipped. Rows that repeat an item's id count as one item. Every document row has a row in the result, repeated rows equal ones.
A very long text fills a segment of its own. Empty tables give empty results, and without items all documents are clean. Further
columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.common import free_name, materialize, rows_of, table, text_key, words

SEGMENT_WORDS = 1_000_000
WINDOW = 10
BLOCK_WORDS = 200_000
SHIFT = np.int64(32)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Index rows: (segment, word, positions) for postings, and (segment, doc_id, first, n_words) with a null word for documents."""
    own = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = own.schema["doc_id"].dataType
    names = ["segment", "word", "positions", "doc_id", "first", "n_words"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 24, 0
        number: dict[bytes, int] = {}
        ids: list[np.ndarray] = []
        docs_in: list[tuple[pa.Scalar, int, int]] = []
        at, id_type = 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            segment = base + made
            size = len(number)
            codes = np.concatenate([*ids, np.zeros(0, np.int64)])
            where = np.concatenate([*(np.arange(first, first + n) for _, first, n in docs_in), np.zeros(0, np.int64)])
            order = np.argsort(codes, kind="stable")
            where, counts = where[order].astype(np.int32), np.bincount(codes, minlength=size)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(where))
            sorted_words = sorted(number)
            lists = lists.take(pa.array([number[w] for w in sorted_words], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, segment)), pa.array([w.decode("utf-8", "replace") for w in sorted_words], pa.string()), lists, pa.nulls(size, id_type), pa.nulls(size, pa.int32()), pa.nulls(size, pa.int32())], names
            )
            n = len(docs_in)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, segment)), pa.nulls(n, pa.string()), pa.nulls(n, lists.type), pa.array([d.as_py() for d, _, _ in docs_in], id_type), *(pa.array([d[i] for d in docs_in], pa.int32()) for i in (1, 2))], names
            )

        for part, texts in rows_of(batches, "text"):
            id_type = part.column(0).type
            for doc_id, text in zip(part.column(0), texts, strict=True):
                found = words(text or "")
                ids.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int64, len(found)))
                docs_in.append((doc_id, at, len(found)))
                at += len(found) + 1
                if at >= segment_words:
                    yield from flush()
                    made, at = made + 1, 0
                    number, ids, docs_in = {}, [], []
        if docs_in:
            yield from flush()

    return own.mapInArrow(run, f"segment bigint, word string, positions array<int>, doc_id {kind.simpleString()}, first int, n_words int")


@dataclass
class Phrases:
    """Distinct phrases of a block of items: a row of word numbers each, -1 after a short one's end, and the items that hold it."""

    vocabulary: list[str]
    codes: np.ndarray
    items: list
    pairs: np.ndarray  # (phrase, index of item)


def phrases_of(texts: list[tuple[object, str]], window: int) -> Phrases:
    number: dict[bytes, int] = {}
    seen: dict[tuple[int, ...], int] = {}
    names: dict[object, int] = {}
    pairs = set()
    for item, text in texts:
        ids = [number.setdefault(w, len(number)) for w in words(text)]
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            pairs.add((seen.setdefault(tuple(ids[i : i + window]), len(seen)), names.setdefault(item, len(names))))
    codes = np.full((len(seen), window), -1, np.int64)
    for phrase, row in seen.items():
        codes[row, : len(phrase)] = phrase
    return Phrases([w.decode("utf-8", "replace") for w in number], codes, list(names), np.array(sorted(pairs), np.int64).reshape(-1, 2))


def occurrences(phrases: Phrases, lists: dict[int, np.ndarray], chunk: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, first position) of every occurrence in one segment, from its postings by word number."""
    size = len(phrases.vocabulary)
    counts = np.array([len(lists.get(w, ())) for w in range(size)] + [0], np.int64)
    keys = np.concatenate([*((np.int64(w) << SHIFT) + lists[w].astype(np.int64) for w in range(size) if w in lists), np.zeros(0, np.int64)])
    begins = np.concatenate([[0], np.cumsum(counts[:-1])])
    used = phrases.codes >= 0
    length = used.sum(1)
    often = np.where(used, counts[phrases.codes], np.iinfo(np.int64).max)
    order = np.argsort(often, axis=1, kind="stable")  # offsets, from the rarest word to the most frequent
    fewest = np.take_along_axis(often, order[:, :1], 1)[:, 0]
    live = np.flatnonzero(fewest > 0)
    out_p, out_at = [], []
    sums = np.cumsum(fewest[live])
    for lo, hi in zip(*(lambda cuts: (cuts[:-1], cuts[1:]))(np.unique(np.r_[0, np.searchsorted(sums, np.arange(chunk, sums[-1] if len(sums) else 0, chunk)) + 1, len(live)])), strict=True):
        rows = live[lo:hi]
        n = fewest[rows]
        offset = order[rows, 0]
        start = np.repeat(begins[phrases.codes[rows, offset]] - np.cumsum(n) + n, n) + np.arange(n.sum())
        p, at = np.repeat(rows, n), (keys[start] & np.int64(0xFFFFFFFF)) - np.repeat(offset, n)
        p, at = p[at >= 0], at[at >= 0]
        for k in range(1, phrases.codes.shape[1]):
            if not len(p):
                break
            o = order[p, k]
            wanted = (phrases.codes[p, o] << SHIFT) + at + o
            found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            stay = (length[p] <= k) | (keys[found] == wanted)
            p, at = p[stay], at[stay]
        out_p.append(p)
        out_at.append(at)
    return np.concatenate([*out_p, np.zeros(0, np.int64)]), np.concatenate([*out_at, np.zeros(0, np.int64)])


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[object, str]]]:
    """The test items with an id and a text, in blocks of about ``block_words`` words that the driver can hold."""
    own = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")).dropna()
    size = own.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // (5 * block_words)))
    for k in range(n):
        rows = own.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k).toArrow() if n > 1 else own.toArrow()
        yield sorted(zip(rows["item"].to_pylist(), rows["text"].to_pylist(), strict=True), key=lambda r: (str(r[0]), r[1]))


def segments_with(index: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Document rows of the index, and the postings of a block's words."""
    wanted = index.sparkSession.createDataFrame(pa.table({"word": pa.array(vocabulary, pa.string())}))
    postings = index.where(F.col("word").isNotNull()).join(F.broadcast(wanted), "word", "left_semi")
    return index.where(F.col("word").isNull()).unionByName(postings.select(index.columns))


def phrase_matches(index: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, merged ``spans`` of words inside any occurrence of a window, and the ``items`` they come from."""
    doc_type, item_type = index.schema["doc_id"].dataType, items.schema[id_col].dataType
    schema = f"segment bigint, first int, doc_id {doc_type.simpleString()}, n_words int, spans array<struct<`from`:int,`to`:int>>, items array<{item_type.simpleString()}>"

    def matcher(phrases: Phrases):  # noqa: ANN202
        shared = index.sparkSession.sparkContext.broadcast(phrases)

        def match(rows: pa.Table) -> pa.Table:
            ph: Phrases = shared.value
            number = {w: i for i, w in enumerate(ph.vocabulary)}
            is_doc = np.asarray(rows["word"].is_null())
            docs = rows.filter(pa.array(is_doc)).sort_by("first")
            posts = rows.filter(pa.array(~is_doc)).select(["word", "positions"]).combine_chunks()
            lists = {number[w]: np.asarray(p.values) for w, p in zip(posts["word"].to_pylist(), posts["positions"], strict=True)}
            p, at = occurrences(ph, lists)
            first, n = (np.asarray(docs[c], dtype=np.int64) for c in ("first", "n_words"))
            hit = np.zeros(int(first[-1] + n[-1] + 2) if len(first) else 1, np.int32)
            np.add.at(hit, at, 1)
            np.add.at(hit, at + (ph.codes[p] >= 0).sum(1), -1)
            edge = np.diff(np.concatenate([[0], (np.cumsum(hit) > 0).astype(np.int8)]))
            begin, end = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
            home = np.searchsorted(first, begin, "right") - 1
            spans: dict[int, list] = {}
            for d, a, b in zip(home.tolist(), begin.tolist(), end.tolist(), strict=True):
                spans.setdefault(d, []).append({"from": a - int(first[d]), "to": b - int(first[d])})
            of_doc = np.unique(np.column_stack([p, np.searchsorted(first, at, "right") - 1]), axis=0)
            lo, hi = np.searchsorted(ph.pairs[:, 0], of_doc[:, 0]), np.searchsorted(ph.pairs[:, 0], of_doc[:, 0], "right")
            found: dict[int, set] = {}
            for (_, d), a, b in zip(of_doc.tolist(), lo.tolist(), hi.tolist(), strict=True):
                found.setdefault(d, set()).update(ph.pairs[a:b, 1].tolist())
            each = range(docs.num_rows)
            return docs.select(["segment", "first", "doc_id", "n_words"]).append_column(
                "spans", pa.array([spans.get(d, []) for d in each], pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])))
            ).append_column("items", pa.array([[ph.items[i] for i in sorted(found.get(d, ()))] for d in each], pa.list_(pa.array(ph.items).type if ph.items else pa.int64())).cast(pa.list_(arrow_type(item_type))))

        return match

    found = None
    blocks = 0
    for texts in item_blocks(items, id_col, text_col, block_words):
        phrases = phrases_of(texts, window)
        own = segments_with(index, phrases.vocabulary).groupBy("segment").applyInArrow(matcher(phrases), schema)
        found = own if found is None else found.unionByName(own)
        blocks += 1
    if blocks > 1:
        merged = found.groupBy("segment", "first", "doc_id", "n_words").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        found = merged.withColumn("spans", joined(F.col("spans")))
    return found.select("doc_id", "n_words", "spans", "items")


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def joined(spans: Column) -> Column:
    """Sorted spans with those that meet made one."""
    one = F.array(F.element_at(spans, 1))
    return F.when(F.size(spans) == 0, spans).otherwise(
        F.aggregate(
            F.slice(spans, 2, F.greatest(F.size(spans) - 1, F.lit(0))),
            one,
            lambda out, x: F.when(
                x["from"] <= F.element_at(out, -1)["to"],
                F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(F.element_at(out, -1)["from"].alias("from"), F.greatest(F.element_at(out, -1)["to"], x["to"]).alias("to")))),
            ).otherwise(F.concat(out, F.array(x))),
        )
    )


def proximity_matches(index: DataFrame, queries: DataFrame, slop: int = 20, id_col: str = "item_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(item, doc_id, from, to): shortest runs of at most ``slop`` words that hold every distinct word of a query, in any order."""
    item_type = queries.schema[id_col].dataType
    schema = f"item {item_type.simpleString()}, doc_id {index.schema['doc_id'].dataType.simpleString()}, `from` int, `to` int"

    def matcher(wanted: list[tuple[object, list[str]]]):  # noqa: ANN202
        def match(rows: pa.Table) -> pa.Table:
            is_doc = np.asarray(rows["word"].is_null())
            docs = rows.filter(pa.array(is_doc)).sort_by("first")
            posts = rows.filter(pa.array(~is_doc)).select(["word", "positions"]).combine_chunks()
            lists = {w: np.asarray(p.values) for w, p in zip(posts["word"].to_pylist(), posts["positions"], strict=True)}
            first = np.asarray(docs["first"], dtype=np.int64)
            out = []
            for item, terms in wanted:
                if not terms or any(t not in lists for t in terms):
                    continue
                rare = min((lists[t] for t in terms), key=len)
                near = []
                for k, t in enumerate(terms):
                    p = lists[t]
                    i = np.searchsorted(rare, p)
                    gap = np.minimum(np.abs(p - rare[np.minimum(i, len(rare) - 1)]), np.abs(p - rare[np.maximum(i - 1, 0)]))
                    near += [(int(x), k) for x in p[gap < slop]]
                near.sort()
                out += [(item, *s) for s in shortest_runs(near, len(terms), slop)]
            home = np.searchsorted(first, [a for _, a, _ in out], "right") - 1 if out else np.zeros(0, int)
            keep = [k for k, d in enumerate(home) if out[k][2] <= first[d] + docs["n_words"][int(d)].as_py()]
            return pa.table(
                {
                    "item": pa.array([out[k][0] for k in keep], arrow_type(item_type)),
                    "doc_id": docs["doc_id"].take(pa.array([int(home[k]) for k in keep], pa.int64())),
                    "from": pa.array([out[k][1] - int(first[home[k]]) for k in keep], pa.int32()),
                    "to": pa.array([out[k][2] - int(first[home[k]]) for k in keep], pa.int32()),
                }
            )

        return match

    found = None
    for texts in item_blocks(queries, id_col, text_col, block_words):
        wanted = [(item, sorted({w.decode() for w in words(text)})) for item, text in texts]
        own = segments_with(index, sorted({w for _, ws in wanted for w in ws})).groupBy("segment").applyInArrow(matcher(wanted), schema)
        found = own if found is None else found.unionByName(own)
    return found


def shortest_runs(near: list[tuple[int, int]], terms: int, slop: int) -> list[tuple[int, int]]:
    """Minimal runs, as [from, to), of sorted (position, term) that hold all terms within ``slop`` positions."""
    out: list[tuple[int, int]] = []
    held: dict[int, int] = {}
    left = 0
    for position, term in near:
        held[term] = held.get(term, 0) + 1
        while held[near[left][1]] > 1:
            held[near[left][1]] -= 1
            left += 1
        if len(held) == terms and position - near[left][0] < slop and (not out or out[-1][0] != near[left][0]):
            out.append((near[left][0], position + 1))
    return out


def indexed(docs: DataFrame, **columns: str) -> DataFrame:
    """The index of the documents as a stored table."""
    return materialize(build_index(docs, **columns), "token-postings")


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that hold no window of any item. Equal texts share their lot; rows without a text stay."""
    key = free_name(docs.columns, "text_key")
    keyed = docs.withColumn(key, text_key(docs[text_col]))
    hit = phrase_matches(indexed(keyed, id_col=key, text_col=text_col), items).where(F.size("spans") > 0)
    hit = materialize(hit.select(F.col("doc_id").alias(key)).distinct(), "leaked")
    return keyed.join(hit, key, "left_anti").select(docs.columns)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_matches(indexed(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["to"] - s["from"]).cast("long")
    names = F.sort_array(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


#: Words of both tables as arrays, each 10-word window as a string, and the document words inside matching windows.
OP2_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + 9], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT rid, n, p, array_to_string(w[p:p + n - 1], ' ') AS g FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT rid, item_id, p, n FROM dw JOIN iw USING (n, g)),
h AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM m) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT rid, item_id FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)
"""
