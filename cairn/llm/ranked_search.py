"""Ranked lexical search over an inverted index of documents, by block-max WAND.

The index is a table of segments, each with the postings of some documents, made without a shuffle. A term's postings in a segment, ordered by
document, are cut into blocks of ``BLOCK`` and packed into bytes; beside them lie each block's first and last document and its greatest
impact, that is what one occurrence list adds to a score before the term's weight. ``statistics`` are taken of all documents before, since
impacts depend on how long documents are on average.

A segment is searched for an item by ranges between the ends of blocks. Pointers move over block ends alone (shallow), so the sum of weighted block
maxima bounds every document of a range; ranges whose bound does not exceed the tenth best score so far are passed over. In the others a document that
exceeds it must be in one of the rarer lists, up to the pivot: those blocks are unpacked, and the blocks of frequent terms only where such a document can still exceed it. The best of all segments are merged. Items are searched in groups of bounded size, each with the postings of its terms alone; a frequent term has one row for each
segment, so none is larger than another.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased. A null text has none: such documents and those of no term don't count, and such
items find nothing. Items without an id are left out; rows that repeat an item's id are one item with all their terms. Repeated documents are ranked each by itself;
documents without an id come last among equal scores. A very long text makes its segment larger than others. Empty tables give no rows. Further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.llm.common import column, materialize, rows_of, runs_of, table, words
from cairn.scratch import broadcast_if

BLOCK = 128
SEGMENT_TERMS = 4_000_000
ITEMS = 1_000
TOP = 10
#: Ranges whose documents are scored together, between two looks at the threshold.
STEP = 32
SALTS = 64
#: Query terms that are broadcast; more meet the postings in a salted join.
BROADCAST_ROWS = 200_000
#: Index rows that a task hands over at once.
ROWS = 50_000

INDEX = "segment bigint, term string, df int, firsts array<int>, lasts array<int>, tops array<bigint>, starts array<int>, payload binary, doc_ids array<{kind}>"


@dataclass(frozen=True)
class Statistics:
    """Documents with a term, and all their terms."""

    documents: int
    terms: int

    def norm(self, n: int) -> int:
        """How much the length of a document of ``n`` terms counts against it."""
        return 10 + 90 * n * self.documents // self.terms


def statistics(docs: DataFrame, text_col: str = "text") -> Statistics:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        for _, texts in rows_of(batches, "text"):
            sizes = [len(words(t)) for t in texts if t]
            documents, terms = documents + sum(map(bool, sizes)), terms + sum(sizes)
        yield pa.RecordBatch.from_pydict({"documents": [documents], "terms": [terms]})

    row = docs.select(docs[text_col].alias("text")).mapInArrow(run, "documents bigint, terms bigint").agg(F.sum("documents"), F.sum("terms")).first()
    return Statistics(row[0] or 0, row[1] or 0)


def impacts(tf: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1_000 * tf + 8 * norms)


# Packed blocks: a byte each for the width of gaps and impacts, the gaps between documents (the first is 0), the impacts, both as planes of bytes, lowest first.


def widths(largest: np.ndarray) -> np.ndarray:
    """Bytes, 1 to 4, that hold each number."""
    return np.select([largest < 1 << 8, largest < 1 << 16, largest < 1 << 24], [1, 2, 3], 4)


def pack(blocks: np.ndarray, gaps: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all blocks one after another, and where each begins. ``blocks`` are the numbers of the postings' first blocks, then the end."""
    sizes = np.diff(blocks)
    of = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(len(gaps)) - blocks[:-1][of]
    gap_width, value_width = (widths(np.maximum.reduceat(x, blocks[:-1])) for x in (gaps, values))
    begins = np.concatenate([[0], np.cumsum(2 + sizes * (gap_width + value_width))])
    out = np.zeros(begins[-1], np.uint8)
    out[begins[:-1]], out[begins[:-1] + 1] = gap_width, value_width
    for x, width, start in ((gaps, gap_width, begins[:-1] + 2), (values, value_width, begins[:-1] + 2 + sizes * gap_width)):
        w, at, n = width[of], start[of] + within, sizes[of]
        for plane in range(4):
            own = w > plane
            out[at[own] + plane * n[own]] = (x[own] >> (8 * plane)) & 0xFF
    return out, begins


def unpack(payload: memoryview, begin: int, end: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and impacts of one block."""
    g, v = payload[begin], payload[begin + 1]
    n = (end - begin - 2) // (g + v)
    planes = np.frombuffer(payload, np.uint8, end - begin - 2, begin + 2).reshape(g + v, n).astype(np.int64)
    gaps, values = (sum(p << (8 * i) for i, p in enumerate(part)) for part in (planes[:g], planes[g:]))
    return first + np.cumsum(gaps), values


def build_index(docs: DataFrame, stats: Statistics, id_col: str = "doc_id", text_col: str = "text", segment_terms: int = SEGMENT_TERMS, block: int = BLOCK) -> DataFrame:
    """Index rows: a term's postings in a segment, and for each segment one row with a null term and the ids of its documents, in their order."""
    own = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()

    def segment_of(number: int, ids: list, sizes: list[int], vocabulary: dict[bytes, int], codes: np.ndarray, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        pairs = codes.astype(np.int64) << 32 | np.repeat(place, sizes)
        pairs.sort()
        begins = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        tf = np.diff(np.concatenate([begins, [len(pairs)]]))
        pairs = pairs[begins]
        term, doc = pairs >> 32, pairs & 0xFFFFFFFF
        values = impacts(tf, np.array([stats.norm(sizes[i]) for i in order], np.int64)[doc])
        # a block begins where a term does and at every ``block``-th posting of it
        counts = np.bincount(term, minlength=len(vocabulary))
        since = np.arange(len(term)) - np.repeat(np.cumsum(counts) - counts, counts)
        edges = np.concatenate([np.flatnonzero(since % block == 0), [len(term)]])
        gaps = np.diff(doc, prepend=0)
        gaps[edges[:-1]] = 0
        payload, starts = pack(edges, gaps, values)
        lists = np.concatenate([[0], np.cumsum(-(-counts // block))])  # blocks of each term
        at = starts[lists]
        of_block = np.repeat(np.arange(len(counts)), np.diff(lists))
        offsets = pa.array(lists, pa.int32())
        arrays = [pa.ListArray.from_arrays(offsets, pa.array(x, t)) for x, t in (
            (doc[edges[:-1]], pa.int32()), (doc[edges[1:] - 1], pa.int32()), (np.maximum.reduceat(values, edges[:-1]), pa.int64()), (starts[:-1] - at[of_block], pa.int32()))]
        packed = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(payload.tobytes())])
        n, terms = len(counts), pa.array([w.decode("utf-8", "replace") for w in vocabulary], pa.string())
        rows = pa.RecordBatch.from_arrays([pa.array(np.full(n, number)), terms, pa.array(counts, pa.int32()), *arrays, packed, pa.nulls(n, pa.list_(id_type))], names)
        yield from (rows.slice(i, ROWS) for i in range(0, n, ROWS))
        yield pa.RecordBatch.from_arrays([pa.array([number]), *(pa.nulls(1, c.type) for c in rows.columns[1:-1]), pa.array([[ids[i] for i in order]], pa.list_(id_type))], names)

    names = ["segment", "term", "df", "firsts", "lasts", "tops", "starts", "payload", "doc_ids"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, held = TaskContext.get().partitionId() << 24, 0, 0
        ids, sizes, codes, vocabulary, id_type = [], [], [], {}, None
        for part, texts in rows_of(batches, "text"):
            id_type = part.column(0).type
            for doc_id, text in zip(column(part, "doc_id"), texts, strict=True):
                found = words(text or "")
                if not found:
                    continue
                codes.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in found), np.int32, len(found)))
                ids.append(doc_id)
                sizes.append(len(found))
                held += len(found)
                if held >= segment_terms:
                    yield from segment_of(base + made, ids, sizes, vocabulary, np.concatenate(codes), id_type)
                    made, held = made + 1, 0
                    ids, sizes, codes, vocabulary = [], [], [], {}
        if ids:
            yield from segment_of(base + made, ids, sizes, vocabulary, np.concatenate(codes), id_type)

    return own.mapInArrow(run, INDEX.format(kind=kind))


# One segment, one item.


@dataclass
class Postings:
    """A term's row of one segment."""

    weight: int
    firsts: np.ndarray
    lasts: np.ndarray
    tops: np.ndarray
    starts: np.ndarray
    payload: memoryview


class Search:
    """Block-max WAND over one segment's postings of an item's terms; ``unpacked`` counts the blocks that were decompressed."""

    def __init__(self, terms: list[Postings], top: int = TOP) -> None:
        self.terms, self.top, self.unpacked = terms, top, 0
        self.of = np.repeat(np.arange(len(terms)), [len(t.firsts) for t in terms])
        self.number = np.concatenate([np.arange(len(t.firsts)) for t in terms])
        self.firsts, self.lasts = (np.concatenate([getattr(t, x) for t in terms]) for x in ("firsts", "lasts"))
        self.most = np.concatenate([t.tops * t.weight for t in terms])

    def ranges(self) -> tuple[np.ndarray, np.ndarray]:
        """Where ranges of documents begin (and the end), and the bound of each: the sum of the weighted maxima of the blocks that reach into it."""
        edges = np.unique(np.concatenate([self.firsts, self.lasts + 1]))
        change = np.zeros(len(edges), np.int64)
        np.add.at(change, np.searchsorted(edges, self.firsts), self.most)
        np.subtract.at(change, np.searchsorted(edges, self.lasts + 1), self.most)
        return edges, np.cumsum(change)[:-1]

    def threshold(self) -> int:
        """A score that ``top`` documents reach for certain: the blocks of one term hold different documents, each with its maximum."""
        least, k = 0, self.top
        for t in self.terms:
            if len(t.tops) >= k:
                least = max(least, int(np.partition(t.tops, -k)[-k]) * t.weight)
        return least - 1  # equal scores still count

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the best, ties to the smaller document."""
        edges, bounds = self.ranges()
        theta = max(self.threshold(), 0)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        pending = np.flatnonzero(bounds > theta)
        # the ranges of the greatest bounds come first, since the threshold that they give lets most others be passed over; the rest follow in order
        step = np.sort(pending[np.argsort(-bounds[pending], kind="stable")[:STEP]])
        pending = np.setdiff1d(pending, step)
        while len(step):
            found, sums = self.score(edges[step], edges[step + 1], theta)
            docs, scores = np.concatenate([docs, found]), np.concatenate([scores, sums])
            if len(docs) > self.top:
                order = np.lexsort((docs, -scores))[: self.top]
                docs, scores = docs[order], scores[order]
            if len(docs) == self.top and scores.min() - 1 > theta:
                theta = int(scores.min()) - 1  # an equal score of a smaller document is better
                pending = pending[bounds[pending] > theta]
            step, pending = pending[:STEP], pending[STEP:]
        kept = scores > 0
        order = np.lexsort((docs[kept], -scores[kept]))
        return docs[kept][order], scores[kept][order]

    def score(self, begins: np.ndarray, ends: np.ndarray, theta: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the ranges, with scores; every one that exceeds the threshold is among them.

        In each range the blocks of the most frequent terms stay packed as long as their maxima together don't exceed the threshold: a document must be in
        one of the others. They are unpacked only where such a document may still exceed it.
        """
        low = np.searchsorted(ends, self.firsts, side="right")
        count = np.maximum(np.searchsorted(begins, self.lasts, side="right") - low, 0)
        block = np.repeat(np.arange(len(count)), count)
        span = low[block] + np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
        order = np.lexsort(((self.lasts - self.firsts)[block], span))
        block, span = block[order], span[order]
        most = self.most[block]
        total = np.cumsum(most)
        starts = np.searchsorted(span, np.arange(len(begins)))
        free = total - (total[starts] - most[starts])[span] <= theta
        rest = np.bincount(span[free], most[free], len(begins)).astype(np.int64)
        first = np.unique(block[~free])
        docs, values = self.opened(first, begins, ends)
        docs, at = np.unique(docs, return_inverse=True)
        sums = np.bincount(at, values, len(docs)).astype(np.int64)
        kept = sums + rest[np.searchsorted(begins, docs, side="right") - 1] > theta
        docs, sums = docs[kept], sums[kept]
        others = np.setdiff1d(block[free], first)
        others = others[np.searchsorted(docs, self.firsts[others]) < np.searchsorted(docs, self.lasts[others], side="right")]
        more, values = self.opened(others, begins, ends)
        at = np.searchsorted(docs, more)
        known = docs[np.minimum(at, len(docs) - 1)] == more if len(docs) else np.zeros(len(more), bool)
        np.add.at(sums, at[known], values[known])
        return docs, sums

    def opened(self, blocks: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the blocks that lie in the ranges, and what the block's term adds to each."""
        self.unpacked += len(blocks)
        docs, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for b in blocks.tolist():
            t, k = self.terms[self.of[b]], int(self.number[b])
            end = int(t.starts[k + 1]) if k + 1 < len(t.starts) else len(t.payload)
            d, v = unpack(t.payload, int(t.starts[k]), end, int(t.firsts[k]))
            docs.append(d)
            values.append(v * t.weight)
        doc, value = np.concatenate(docs), np.concatenate(values)
        at = np.searchsorted(begins, doc, side="right") - 1
        inside = (at >= 0) & (doc < ends[at])
        return doc[inside], value[inside]


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, term), each once."""
    own = items.where(items[id_col].isNotNull()).select(items[id_col].alias("item_id"), items[text_col].alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in rows_of(batches, "text"):
            found = [sorted(set(words(t or ""))) for t in texts]
            which = np.repeat(np.arange(len(found)), [len(f) for f in found])
            terms = [w.decode("utf-8", "replace") for f in found for w in f]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(which, pa.int64())), pa.array(terms, pa.string())], ["item_id", "term"])

    return own.mapInArrow(run, f"item_id {own.schema['item_id'].dataType.simpleString()}, term string").distinct()


def search(index: DataFrame, items: DataFrame, stats: Statistics, id_col: str = "item_id", text_col: str = "text", top: int = TOP, per_group: int = ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` best documents of a stored index."""
    asked = materialize(item_terms(items, id_col, text_col), "item-terms")
    kind, doc_kind = asked.schema["item_id"].dataType.simpleString(), index.schema["doc_ids"].dataType.elementType.simpleString()
    groups = max(1, -(-asked.select("item_id").distinct().count() // per_group))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(groups)))
    postings = index.where("term IS NOT NULL").drop("doc_ids")
    known = broadcast_if(asked.select("term").distinct(), 500_000)
    frequency = postings.select("term", "df").join(known, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1_000 * F.ln((2 * F.lit(stats.documents) + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("bigint")
    wanted = asked.join(frequency, "term").groupBy("part", "term", weight.alias("weight")).agg(F.sort_array(F.collect_list("item_id")).alias("items")).where("weight > 0")
    wanted = materialize(wanted, "wanted")
    if wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        both = postings.join(F.broadcast(wanted), "term")
    else:  # a frequent term has a posting row in every segment: its rows are spread over the salts
        salted = wanted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        both = postings.withColumn("salt", F.pmod(F.xxhash64("segment"), F.lit(SALTS)).cast("int")).join(salted, ["term", "salt"]).drop("salt")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (segment, _), own in runs_of(batches, "segment", "part"):
            by_item: dict[object, list[Postings]] = {}
            for batch in own:
                arrays = [batch.column(batch.schema.get_field_index(c)) for c in ("firsts", "lasts", "tops", "starts")]
                data = [batch.column(batch.schema.get_field_index("payload"))[i].as_buffer() for i in range(batch.num_rows)]
                for i, (weight, ids) in enumerate(zip(column(batch, "weight"), column(batch, "items"), strict=True)):
                    terms = Postings(weight, *(a[i].values.to_numpy() for a in arrays), memoryview(data[i]))
                    for item in ids:
                        by_item.setdefault(item, []).append(terms)
            rows: tuple[list, list, list, list] = ([], [], [], [])
            for item, terms in by_item.items():
                docs, scores = Search(terms, top).best()
                for values, new in zip(rows, ([item] * len(docs), [segment] * len(docs), docs.tolist(), scores.tolist()), strict=True):
                    values.extend(new)
            types = (own[0].schema.field("items").type.value_type, pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(rows, types, strict=True)], ["item_id", "segment", "doc", "score"])

    dealt = both.repartition("segment", "part").sortWithinPartitions("segment", "part")
    found = dealt.mapInArrow(run, f"item_id {kind}, segment bigint, doc int, score bigint")
    ids = index.where("term IS NULL").select("segment", "doc_ids")
    named = found.join(ids, "segment").select("item_id", F.element_at("doc_ids", F.col("doc") + 1).cast(doc_kind).alias("doc_id"), "score")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stats = statistics(docs)
    index = materialize(build_index(docs, stats), "postings")
    return search(index, table(spark, sf_dir, "benchmark"), stats)


OP13_SQL = r"""
WITH tokens AS (
    SELECT doc_id, i, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT doc_id, text, row_number() OVER () AS i FROM documents)
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE item_id IS NOT NULL
), lengths AS (SELECT i, count(*) AS n FROM tokens GROUP BY i
), total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths
), counts AS (SELECT doc_id, i, term, count(*) AS tf FROM tokens WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counts, total GROUP BY term, docs
), scores AS (
    SELECT a.item_id, c.i, c.doc_id, sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (10 + (90 * l.n * t.docs) // t.terms))))::BIGINT AS score
    FROM asked a JOIN counts c USING (term) JOIN weights w USING (term) JOIN lengths l ON l.i = c.i CROSS JOIN total t GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0 QUALIFY rank <= 10
"""
