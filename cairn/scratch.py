"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; one of our own only where the session names none and driver and executors are one process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="cairn-checkpoints-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and a lost executor costs one reread."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if(df: DataFrame, rows: int, cheap: bool = False) -> DataFrame:
    """The table with a broadcast hint if it has ``rows`` rows at most; beyond that Spark joins it by a shuffle.

    Its size is counted while the plan is made: from the footers of a stored copy, so that it is worked out once, or from the table itself if
    that is ``cheap``, a scan of stored rows or a short list.
    """
    own = df if cheap else materialize(df, "counted")
    return F.broadcast(own) if own.limit(rows + 1).count() <= rows else own
