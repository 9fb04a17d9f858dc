import random
from collections import Counter

import pytest

from helpers import awkward, documents, frame, prose
from tessera.llm import repeats as R


def brute(rows, size):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + size] for b in texts for i in range(len(b) - size + 1))
    out = []
    for (d, _), b in zip(rows, texts, strict=True):
        mark = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                mark[i : i + size] = b"\1" * size
        spans = sum(m and not (i and mark[i - 1]) for i, m in enumerate(mark))
        out.append((-1 if d is None else d, len(b), sum(mark), spans, bytes(x for x, m in zip(b, mark, strict=True) if not m)))
    return sorted(out)


def corpus():
    passage = prose(70, 60)
    shared = [(200 + i, prose(300 + i, 25) + passage + prose(500 + i, 25)) for i in range(30)]
    near = [(300 + i, prose(71, 80)[: 100 + i * 7] + "XY" + prose(71, 80)[100 + i * 7 :]) for i in range(12)]
    runs = [(400, "ab" * 300), (401, "a" * 500), (402, "ab" * 20), (403, prose(72, 60) + prose(72, 60))]
    return [r for r in awkward() if r[0] != 7] + shared + near + runs


@pytest.mark.parametrize("size,hot,limit", [(60, 64, 4096), (61, 3, 8), (400, 2, 4)])
def test_matches_brute_force(spark, monkeypatch, size, hot, limit):
    monkeypatch.setattr(R, "LOCALLY_HOT", hot)
    monkeypatch.setattr(R, "LIMIT", limit)
    monkeypatch.setattr(R, "BLOCK_TEXT", 4000)
    got = R.remove_repeats(frame(spark, corpus(), extra="row"), size).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == brute(corpus(), size)


def test_long_texts_are_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 300)
    rows = [(1, prose(80, 2000)), (2, "x" + prose(80, 2000)[5000:6000] + "y")]
    got = R.remove_repeats(frame(spark, rows), 80).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == brute(rows, 80)


def test_without_repeats_keeps_the_columns(spark):
    docs = documents(spark, [(1, prose(81, 100)), (2, "start é " + prose(81, 100)), (3, prose(82, 30)), (4, ""), (5, prose(81, 100))])
    got = {r.doc_id: r for r in R.without_repeats(docs, 80).collect()}
    assert set(got) == {2, 3, 4} and R.without_repeats(docs, 80).columns == docs.columns
    assert got[2].text == "start é " and all(r.n_chars == len(r.text) for r in got.values())


def test_entries_are_dealt_evenly(spark):
    docs = frame(spark, [(i, "".join(random.Random(i).choices("abcdefgh ", k=3000))) for i in range(40)]).selectExpr("doc_id as row", "text")
    packed = R.entries(docs, 8, 60, 30).where("kind = 0").collect()
    held = Counter()
    for r in packed:
        held[r.slice] += len(R.unpacked(bytes(r.payload), 7)[0])
    total = sum(held.values())
    assert set(held) == set(range(8)) and max(held.values()) < 1.3 * total / 8


def test_empty_table(spark):
    assert R.remove_repeats(frame(spark, []), 40).count() == 0


def test_query(spark, sf_dir):
    import hashlib

    import __spark_entry__ as E

    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in E.queries()["op9_repeats"](spark, sf_dir).collect())
    assert got == [(*r, hashlib.sha256(k).hexdigest()) for *r, k in brute(docs, 400)]
