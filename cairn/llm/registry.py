"""Queries of this subpackage, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cairn.llm.bpe import op5_bpe
from cairn.llm.decontamination import OP2_SQL, op2_decontamination
from cairn.llm.language_id import op1_language_id
from cairn.llm.line_dedup import OP3_SQL, op3_line_dedup
from cairn.llm.merkle import OP11_SQL, op11_merkle_manifest
from cairn.llm.ngram_join import OP8_SQL, op8_ngram_jaccard
from cairn.llm.pii import op7_pii
from cairn.llm.quality_classifier import op6_quality_classifier
from cairn.llm.quality_rules import op10_quality_rules
from cairn.llm.ranked_search import OP13_SQL, op13_ranked_search
from cairn.llm.substring_dedup import op4_substring_dedup
from cairn.llm.vector_search import OP12_SQL, op12_nearest_neighbours
from cairn.llm.warc import OP9_SQL, op9_warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_language_id, op2_decontamination, op3_line_dedup, op4_substring_dedup, op5_bpe, op6_quality_classifier, op7_pii, op8_ngram_jaccard, op9_warc, op10_quality_rules, op11_merkle_manifest, op12_nearest_neighbours, op13_ranked_search)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2_SQL, "op3_line_dedup": OP3_SQL, "op8_ngram_jaccard": OP8_SQL, "op9_warc": OP9_SQL, "op11_merkle_manifest": OP11_SQL, "op12_nearest_neighbours": OP12_SQL, "op13_ranked_search": OP13_SQL}
