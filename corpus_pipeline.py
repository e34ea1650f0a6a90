"""A training corpus from raw documents: quality, repeated lines, near copies, leaked benchmarks, tokens.

Every stage takes null, empty and very long texts, null ids, repeated rows, empty tables and further columns of any name: rows without a text
have no repeated line, no copy and no leak, so they stay unless their quality is low; of repeated rows one stays after the third stage. All stages but the last
return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import bpe, decontamination, line_dedup, ngram_join, quality_classifier
from cairn.llm.common import scratch_path, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels, does not reject."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"), where=quality_classifier.training_rows())
    return quality_classifier.keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line windows; documents that consisted of nothing else go."""
    return line_dedup.drop_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of copies and near copies."""
    return ngram_join.one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and how many these are. Columns of the input that are called ``token_ids`` or ``n_tokens`` give way."""
    return bpe.encode(docs).withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("leaks", leaks), ("tokens", tokens)]

#: The first stage is learnt, and SQL has no BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
