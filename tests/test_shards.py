"""Published shards: descriptions, reading back, lost jobs and damaged files."""

from __future__ import annotations

import gzip
import hashlib
import json
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cairn.sources import shards


def frame(spark, n, mark=""):
    return spark.range(n).repartition(5).select(F.col("id").alias("ordinal"), F.concat(F.lit('{"@id":"n'), F.col("id").cast("string"), F.lit(mark + '"}')).alias("node"), (F.col("id") % 3).alias("triples"))


def ids(spark, path):
    return [r[0] for r in shards.published(spark, path).orderBy("shard", "at").select(F.try_variant_get("node", "$['@id']", "string")).collect()]


def test_descriptions_and_reading_back(spark, tmp_path):
    path = f"file://{tmp_path}/graph"
    assert shards.current(path) is None and shards.described(spark, path).count() == 0 and shards.published(spark, path).count() == 0
    shards.publish(frame(spark, 23), path, size=5)
    rows = {r.shard: r for r in shards.described(spark, path).collect()}
    assert {k: (r.nodes, r.triples) for k, r in rows.items()} == {k: (len(own), sum(i % 3 for i in own)) for k, own in ((k, [i for i in range(23) if i // 5 == k]) for k in range(5))}
    for r in rows.values():
        data = Path(str(tmp_path), "graph", shards.current(path)["snapshot"], r.file).read_bytes()
        text = gzip.decompress(data)
        assert (len(data), hashlib.sha256(data).hexdigest(), len(text), hashlib.sha256(text).hexdigest()) == (r.bytes, r.sha256, r.text_bytes, r.text_sha256) and len(json.loads(text)["@graph"]) == r.nodes
    assert ids(spark, path) == [f"n{i}" for i in range(23)]
    assert shards.shard_faults(spark, path).count() == 0


def test_equal_nodes_make_equal_files(spark, tmp_path):
    for name, n in (("a", 1), ("b", 7)):
        shards.publish(frame(spark, 23).repartition(n), f"file://{tmp_path}/{name}", size=5)
    a, b = ({(r.shard, r.sha256) for r in shards.described(spark, f"file://{tmp_path}/{x}").collect()} for x in "ab")
    assert a == b and len(a) == 5


def test_a_failed_job_leaves_the_old_snapshot(spark, tmp_path):
    path = f"file://{tmp_path}/graph"
    shards.publish(frame(spark, 12), path, size=5)
    broken = frame(spark, 12, "x").withColumn("node", F.when(F.col("ordinal") == 11, F.raise_error(F.lit("lost"))).otherwise(F.col("node")))
    with pytest.raises(Exception, match="lost"):
        shards.publish(broken, path, size=5)
    assert ids(spark, path) == [f"n{i}" for i in range(12)] and shards.shard_faults(spark, path).count() == 0


def test_a_job_killed_before_its_commit_is_not_seen(spark, tmp_path):
    path = f"file://{tmp_path}/graph"
    shards.publish(frame(spark, 12), path, size=5)
    batch = pa.RecordBatch.from_pydict({"shard": [0], "at": [0], "node": ['{"@id":"new"}'], "triples": [0]})
    killed = shards.ShardWriter(path, "", 2)
    killed.write(iter([batch]))  # all its shards are written, and then the driver is gone
    assert ids(spark, path) == [f"n{i}" for i in range(12)]
    twice = shards.ShardWriter(path, "", 2)
    twice.write(iter([batch]))  # an attempt that was lost after it had written
    twice.commit([twice.write(iter([batch])), None])
    assert ids(spark, path) == ["new"]


def test_old_snapshots_go(spark, tmp_path):
    path = f"file://{tmp_path}/graph"
    for mark in "abc":
        shards.publish(frame(spark, 3, mark), path, size=5)
    assert ids(spark, path) == ["n0c", "n1c", "n2c"] and len([p for p in (tmp_path / "graph").iterdir() if p.is_dir()]) == 2
    shards.publish(frame(spark, 0), path)
    assert ids(spark, path) == [] and shards.current(path)["nodes"] == 0


def test_damage_is_named(spark, tmp_path):
    path = f"file://{tmp_path}/graph"
    shards.publish(frame(spark, 20), path, size=5)
    folder = tmp_path / "graph" / shards.current(path)["snapshot"]
    files = {r.shard: folder / r.file for r in shards.described(spark, path).collect()}
    files[0].unlink()
    files[1].write_bytes(files[1].read_bytes() + b"x")
    data = bytearray(files[2].read_bytes())
    data[-1] ^= 1
    files[2].write_bytes(data)
    assert sorted(map(tuple, shards.shard_faults(spark, path).collect())) == [(0, "missing"), (1, "size"), (2, "digest")]
