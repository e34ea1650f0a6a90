from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark: SparkSession):
    """Makes a documents table, in several partitions, of texts or (id, text) pairs."""

    def make(texts: list) -> DataFrame:
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], SCHEMA).repartition(3)

    return make


@pytest.fixture
def prose():
    """Random words, different for each seed."""

    def make(n: int, seed: int, vocabulary: int = 5000) -> list[str]:
        rng = random.Random(seed)
        return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]

    return make
