import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import awkward, frame
from tessera.llm import bitpack as B

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 24, 32])
def test_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 9001, dtype=np.uint64).astype(np.uint32)
    assert np.array_equal(B.unpack(B.pack(ids, bits), len(ids), bits), ids)
    f = B.TokenFile(B.to_file([5, None], [9000, 1], ids, bits, 3, 4))
    assert (f.bits, f.task, f.number, f.null.tolist()) == (bits, 3, 4, [False, True])
    for lo, hi in ((0, 0), (0, 1), (4095, 4097), (0, 9001), (8999, 9001)):
        assert np.array_equal(f.read(lo, hi), ids[lo:hi])


@pytest.mark.parametrize("bits", [11, 16, 24, 32])
def test_checksums_unpack_each_block_once(bits, monkeypatch):
    counts = [0, 3, 4093, 1, 0, 9000, 5, 0, 4096 * 2, 7, 0]
    ids = np.random.default_rng(bits).integers(0, 2**bits, sum(counts), dtype=np.uint64).astype(np.uint32)
    f = B.TokenFile(B.to_file(list(range(len(counts))), counts, ids, bits, 0, 0))
    ends = np.cumsum([0, *counts]).tolist()
    want = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(ends, ends[1:], strict=False)]
    calls, plain = [], B.unpack
    monkeypatch.setattr(B, "unpack", lambda *a: calls.append(1) or plain(*a))
    assert f.crc32s() == want and len(calls) == len(f.block_offsets) - 1


def test_signs_behind_a_word_are_encoded_once():
    encoder = B.PieceEncoder(PATH)
    texts = [f"w{'abcdefghij'[i]}x{s}" for i in range(10) for s in ("%%%", "###,", "'", "?!", ".\"", "<|", "<|endoftext|>")]
    texts += ["don't'", "a1%", "é%", "x=\u0338", "Σ1.", "ΑΣ.'a%", "a\u0301.", "It's.'", "'ll.", "%%%", "Ab%<|x%"]
    asked, plain = [], encoder.plain
    encoder.plain = lambda pieces: asked.extend(pieces) or plain(pieces)
    want = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode([t.encode() for t in texts]) == want
    assert sum(p.endswith(b"###,") for p in asked) == 1
    assert encoder.encode([" ".join(texts[:30]).encode()]) == [np.array(encoder.tokenizer.encode(" ".join(texts[:30]), add_special_tokens=False).ids, "<u4").tobytes()]


def test_width():
    assert [B.width(n) for n in (1, 2, 3, 49408, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


@pytest.fixture(scope="module")
def encoder():
    return B.PieceEncoder(PATH)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("aB é,.'s1 \n\t<| ́Σςİ")), st.characters(exclude_categories=["Cs"])), max_size=30))
def test_pieces_encode_as_the_whole_text(encoder, text):
    want = np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert encoder.encode([text.encode()]) == [want]


def expected(encoder, rows):
    out, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_files_of_awkward_rows(spark, encoder, monkeypatch):
    monkeypatch.setattr(B, "FILE_IDS", 500)
    got = B.token_index(frame(spark, extra="start"), PATH).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == expected(encoder, awkward())


def test_empty_table(spark):
    assert B.token_index(frame(spark, []), PATH).count() == 0


def test_query(spark, sf_dir, encoder):
    import __spark_entry__ as E

    got = E.queries()["op5_token_files"](spark, sf_dir).orderBy("start").collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert [tuple(r) for r in got] == expected(encoder, docs)
