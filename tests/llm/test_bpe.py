import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import awkward, frame
from tessera.llm import bpe

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def words():
    return bpe.words_for(PATH)


def library(words, text):
    ids = words.tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), words.tokenizer.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("aB é,.'s1 \n\t\0 ́½")), st.characters(exclude_categories=["Cs"])), max_size=30))
def test_words_encode_as_the_whole_text(words, text):
    ids = b"".join(words.encode(words.of(text)))
    assert (ids, bpe.Pieces(words.tokenizer).decode(ids)) == library(words, text)


def test_documents_match_the_library(spark, words, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_TEXT", 5000)
    got = bpe.encode_decode(frame(spark, extra="ids"), PATH).collect()
    assert sorted((r.doc_id or -1, bytes(r.ids), r.decoded) for r in got) == sorted((d or -1, *library(words, t)) for d, t in awkward())


def test_empty_table(spark):
    assert bpe.encode_decode(frame(spark, []), PATH).count() == 0


def test_extra_columns_pass(spark):
    got = bpe.encode_decode(frame(spark, [(1, "a b")], extra="block"), PATH).first()
    assert (got["block"], got["doc_id"]) == ("x", 1)


def test_query(spark, sf_dir, words):
    import __spark_entry__ as E

    rows = {r.doc_id: r for r in E.queries()["op1_bpe"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids, decoded = library(words, d.text)
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
