"""Streams over pages and events: resumable ingestion, first-wins de-duplication and sequence checks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def page_stream(spark: SparkSession, path: str, files_at_once: int = 100) -> DataFrame:
    """(page, payload) of JSON files as they arrive; the checkpoint of the query that reads it remembers which were seen."""
    files = spark.readStream.option("wholetext", "true").option("maxFilesPerTrigger", files_at_once).text(path)
    return files.select(F.input_file_name().alias("page"), F.try_parse_json("value").alias("payload"))


def ingest(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Append what is new to a table, once, and stop."""
    rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def first_seen(rows: DataFrame, key: str, at: str, keep: str = "7 days") -> DataFrame:
    """One row for each key within the time that state is kept."""
    return rows.withWatermark(at, keep).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, at: str, by: str, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(at, late).groupBy(F.window(at, width), by).agg(F.count(F.lit(1)).alias("n"))


def sequence_gaps(events: DataFrame, group: str, number: str) -> DataFrame:
    """(group, expected, found) whenever a group's next number isn't one more than its last; numbers of a batch are taken in order.

    State is one number for each group.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        expected = state.get[0] if state.exists else 0
        out = []
        for n in sorted(int(x) for f in frames for x in f[number]):
            if n != expected:
                out.append((key[0], expected, n))
            expected = n + 1
        state.update((expected,))
        yield pd.DataFrame(out, columns=["group", "expected", "found"])

    kind = events.schema[group].dataType.simpleString()
    schema = f"group {kind}, expected bigint, found bigint"
    return events.groupBy(group).applyInPandasWithState(step, schema, "expected bigint", "append", GroupStateTimeout.NoTimeout)
