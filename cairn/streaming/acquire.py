"""Acquisition of paged sources as a stateful stream: each source is a loop from page to page, with a reason for its end.

Pages come as they were recorded, in any order and possibly more than once. A source's state holds what the loop asks for next, the ids that it has kept, the requests
that it has made, and pages that came before their turn, so a run that stops goes on where it was. The first record of an id stays. Pages after the end are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Why a source ends.
EXHAUSTED, PAGES, ITEMS, REPEATED = "sourceExhausted", "maximumPages", "maximumItems", "repeatedRequest"
#: A page of a feed: the request that it answers, the ids on it (null where a record has none), how many records the source reports, and the request that follows.
PAGE = "source string, request string, ids array<string>, reported bigint, following string, maximum_pages int, maximum_items int"
RECEIPT = "source string, page int, request string, upstream int, normalised int, kept array<string>, items bigint, reported bigint, reason string, complete boolean"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class PageLoop(StatefulProcessor):
    """One source."""

    def __init__(self, first: str) -> None:
        self.first = first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.loop = handle.getValueState("loop", "request string, pages int, items bigint, reported bigint, reason string")
        self.waiting = handle.getMapState("waiting", "request string", "ids array<string>, reported bigint, following string, maximum_pages int, maximum_items int")
        self.asked = handle.getMapState("asked", "request string", "page int")
        self.seen = handle.getMapState("seen", "id string", "page int")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        request, pages, items, reported, reason = self.loop.get() if self.loop.exists() else (self.first, 0, 0, None, None)
        for frame in rows:
            if reason is not None:
                continue
            for row in frame.itertuples(index=False):
                if not self.asked.containsKey((row.request,)) and not self.waiting.containsKey((row.request,)):
                    whole = lambda v: None if pd.isna(v) else int(v)
                    ids = [] if row.ids is None else [None if x is None else str(x) for x in row.ids]
                    self.waiting.updateValue((row.request,), (ids, whole(row.reported), row.following, whole(row.maximum_pages), whole(row.maximum_items)))
        out = []
        while reason is None and self.waiting.containsKey((request,)):
            ids, total, following, most_pages, most_items = self.waiting.getValue((request,))
            self.waiting.removeKey((request,))
            pages += 1
            self.asked.updateValue((request,), (pages,))
            if total is not None:
                reported = total if reported is None else max(reported, total)
            kept, named = [], [i for i in ids if i]
            for i in named:
                if not self.seen.containsKey((i,)):
                    self.seen.updateValue((i,), (pages,))
                    kept.append(i)
                    items += 1
                if most_items is not None and items >= most_items:
                    reason = EXHAUSTED if reported is not None and items >= reported else ITEMS
                    break
            complete = reason == EXHAUSTED
            if reason is None and following is None:
                reason, complete = EXHAUSTED, True
            if reason is None and most_pages is not None and pages >= most_pages:
                reason = PAGES
            if reason is None and self.asked.containsKey((following,)):
                reason = REPEATED
            out.append((key[0], pages, request, len(ids), len(named), kept, items, reported, reason, complete))
            request = following if following is not None else request
        self.loop.update((request, pages, items, reported, reason))
        if reason is not None:
            self.waiting.clear()
        if out:
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in RECEIPT.split(", ")])
            yield frame.astype({"reported": "Int64"})


def acquired(pages: DataFrame, first: str = "0") -> DataFrame:
    """Receipts of the pages that each source's loop has taken, with the ids that it kept and, on the last one, why it ended. ``pages`` is a stream of ``PAGE``."""
    return pages.groupBy("source").transformWithStateInPandas(PageLoop(first), RECEIPT, "Append", "None")


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Keeps state in RocksDB, which maps need, for queries started meanwhile."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def run(spark: SparkSession, feed: str, receipts: str, checkpoint: str, files_at_once: int = 1_000) -> None:
    """Take what a folder of recorded pages holds beyond the last run, and stop. The checkpoint keeps the loops' state and which files were read."""
    pages = spark.readStream.schema(PAGE).option("maxFilesPerTrigger", files_at_once).parquet(feed)
    with state_store(spark):
        acquired(pages).writeStream.format("parquet").option("path", receipts).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def summary(receipts: DataFrame) -> DataFrame:
    """A row for each source: pages, records seen, dropped and kept, what is missing of those reported, the reason and whether all is covered; an open loop has no reason."""
    own = receipts.groupBy("source").agg(
        F.max("page").alias("pages"), F.sum("upstream").alias("upstream"), F.sum("normalised").alias("normalised"), F.max("items").alias("items"), F.max("reported").alias("reported"), F.max("reason").alias("reason"),
        F.bool_or("complete").alias("complete"),
    )
    dropped = F.greatest(F.col("upstream") - F.col("normalised"), F.lit(0))
    whole = F.col("complete") & (dropped == 0) & (F.col("reported").isNull() | (F.col("items") == F.col("reported")))
    return own.select("source", "pages", "upstream", dropped.alias("dropped"), "items", F.greatest(F.col("reported") - F.col("items"), F.lit(0)).alias("unrepresented"), "reason", "complete", whole.alias("coverage_complete"))
