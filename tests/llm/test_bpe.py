from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cairn.llm import bpe

PATH = bpe.default_path()
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.Bpe(PATH)


def check(text: str) -> None:
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text).tolist() == ids
    assert OWN.decode(np.array(ids, np.int64)).decode() == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(blacklist_categories=["Cs"])))
def test_any_text(text):
    check(text)


@settings(max_examples=300, deadline=None)
@given(st.text("abcdehinorst'!.0 \n"))
def test_words(text):
    check(text)


@pytest.mark.parametrize("text", ["", " ", "ΣΑΣ", "İi", "a\x1cb", "<|endoftext|>x<|startoftext|>", "x" * 3000, "ab" * 3000, "don't we'll", "é", "½²", "ꟚA", "₏"])
def test_odd_texts(text):
    check(text)


def test_every_token_spells_itself():
    for token, text in OWN.text.items():
        if text.endswith(bpe.END):
            assert OWN.word(text) == [token]


def test_operator(documents, spark):
    texts = ["Hello world!", None, "", "Hello world!", "naïve café " * 500]
    docs = documents(texts).withColumnRenamed("source", "token_ids")
    rows = {r.doc_id: r for r in bpe.encode(docs, decoded="decoded").collect()}
    for i, t in enumerate(texts):
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        assert rows[i].token_ids == ids
        assert rows[i].decoded == LIBRARY.decode(ids, skip_special_tokens=False)
    again = bpe.decode(bpe.encode(docs).drop("text")).collect()
    assert {r.doc_id: r.decoded for r in again} == {i: r.decoded for i, r in rows.items()}
    assert bpe.encode(documents([]).limit(0)).count() == 0


def test_query(spark):
    rows = bpe.op5_bpe(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = LIBRARY.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
