"""Shards of a graph, published as a whole: compressed documents of consecutive nodes, described by digests, sizes and counts.

A snapshot is a folder of its own. Tasks write its shards under names that no other attempt uses, and a file of descriptions each; only when all are done does
the driver write the small file ``current`` that names the snapshot and the description files, in one step. So a reader finds the old snapshot or the new one, never
part of one, and what lost or repeated attempts left behind is in no description. Descriptions are files, not messages: what goes through the driver grows with tasks alone.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

SHARD = 250
FORMAT = "graph-shards"
DESCRIPTION = "shard bigint, file string, bytes bigint, sha256 string, text_bytes bigint, text_sha256 string, nodes bigint, triples bigint"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def compressed(text: bytes) -> bytes:
    """The same bytes whenever and wherever: no name and no time in the header."""
    return gzip.compress(text, compresslevel=9, mtime=0)


@dataclass
class Described(WriterCommitMessage):
    """A task's file of descriptions, and its totals."""

    file: str
    shards: int
    nodes: int
    triples: int


class ShardWriter(DataSourceArrowWriter):
    """Rows (shard, at, node, triples), dealt by shard and in order, to documents of one shard each."""

    def __init__(self, path: str, context: str, keep: int) -> None:
        self.path, self.context, self.keep, self.version = path, context, keep, f"snapshot-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Described:
        fs, root = filesystem(self.path)
        own = uuid.uuid4().hex
        fs.create_dir(f"{root}/{self.version}", recursive=True)
        rows: list[dict] = []
        number: int | None = None
        held: list[str] = []
        triples = 0

        def close() -> None:
            name = f"shard-{number:08d}-{own}.jsonld.gz"
            text = f'{{"@context":{json.dumps(self.context)},"@graph":[{",".join(held)}]}}'.encode()
            data = compressed(text)
            with fs.open_output_stream(f"{root}/{self.version}/{name}", compression=None) as out:
                out.write(data)
            rows.append({"shard": number, "file": name, "bytes": len(data), "sha256": hashlib.sha256(data).hexdigest(), "text_bytes": len(text), "text_sha256": hashlib.sha256(text).hexdigest(), "nodes": len(held), "triples": triples})

        for batch in iterator:
            for shard, node, n in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("shard", "node", "triples")), strict=True):
                if held and shard != number:
                    close()
                    held, triples = [], 0
                number = shard
                held.append(node)
                triples += n
        if held:
            close()
        with fs.open_output_stream(f"{root}/{self.version}/described-{own}.jsonl", compression=None) as out:
            out.write("".join(json.dumps(r) + "\n" for r in rows).encode())
        return Described(f"described-{own}.jsonl", len(rows), sum(r["nodes"] for r in rows), sum(r["triples"] for r in rows))

    def commit(self, messages: list[Described | None]) -> None:
        fs, root = filesystem(self.path)
        done = [m for m in messages if m is not None]
        before = current(self.path)
        history = ([self.version] + (before["history"] if before else []))[: self.keep]
        now = {"snapshot": self.version, "described": [m.file for m in done], "history": history} | {k: sum(getattr(m, k) for m in done) for k in ("shards", "nodes", "triples")}
        with fs.open_output_stream(f"{root}/current-{self.version}", compression=None) as out:
            out.write(json.dumps(now).encode())
        fs.move(f"{root}/current-{self.version}", f"{root}/current")
        for old in set(before["history"] if before else []) - set(history):
            fs.delete_dir(f"{root}/{old}")

    def abort(self, messages: list[Described | None]) -> None:
        fs, root = filesystem(self.path)
        if fs.get_file_info(f"{root}/{self.version}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.version}")


class ShardSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "shard bigint, at bigint, node string, triples bigint"

    def writer(self, schema: T.StructType, overwrite: bool) -> ShardWriter:
        return ShardWriter(self.options["path"], self.options.get("context", ""), int(self.options.get("keep", "2")))


def publish(nodes: DataFrame, path: str, context: str = "https://schema.example/context", size: int = SHARD, keep: int = 2) -> None:
    """Publish nodes (ordinal, node, triples), ``node`` being JSON, as shards of ``size`` consecutive ordinals. The ``keep`` last snapshots stay, for readers under way."""
    nodes.sparkSession.dataSource.register(ShardSource)
    rows = nodes.select(F.floor(F.col("ordinal") / size).alias("shard"), F.col("ordinal").cast("bigint").alias("at"), "node", F.col("triples").cast("bigint").alias("triples"))
    dealt = rows.repartition("shard").sortWithinPartitions("shard", "at")
    dealt.write.format(FORMAT).option("path", path).option("context", context).option("keep", keep).mode("append").save()


def current(path: str) -> dict | None:
    """What ``current`` says; null where nothing has been published."""
    fs, root = filesystem(path)
    if fs.get_file_info(f"{root}/current").type != pafs.FileType.File:
        return None
    with fs.open_input_file(f"{root}/current") as file:
        return json.loads(file.read())


def described(spark: SparkSession, path: str) -> DataFrame:
    """Descriptions of the published shards."""
    now = current(path)
    if not now or not now["described"]:
        return spark.createDataFrame([], DESCRIPTION)
    return spark.read.schema(DESCRIPTION).json([f"{path}/{now['snapshot']}/{f}" for f in now["described"]])


def published(spark: SparkSession, path: str) -> DataFrame:
    """(shard, at, node) of the published snapshot; ``node`` is a variant. Files that no description names aren't read as shards."""
    now = current(path)
    if not now or not now["shards"]:
        return spark.createDataFrame([], "shard bigint, at int, text string").select("shard", "at", F.parse_json("text").alias("node"))
    texts = spark.read.text(f"{path}/{now['snapshot']}/*.jsonld.gz", wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.parse_json("value").alias("doc"))
    own = texts.join(described(spark, path).select("shard", "file"), "file").select("shard", F.try_variant_get("doc", "$['@graph']", "array<variant>").alias("graph"))
    return own.select("shard", F.posexplode("graph").alias("at", "node"))


def shard_faults(spark: SparkSession, path: str) -> DataFrame:
    """(shard, fault): published shards whose file is missing or has another size or digest than described."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jsonld.gz").load(f"{path}/{current(path)['snapshot']}")
    found = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("found_bytes"), F.sha2("content", 256).alias("found"))
    both = described(spark, path).join(found, "file", "left")
    fault = F.when(F.col("found").isNull(), "missing").when(F.col("found_bytes") != F.col("bytes"), "size").when(F.col("found") != F.col("sha256"), "digest")
    return both.select("shard", fault.alias("fault")).where("fault IS NOT NULL")
