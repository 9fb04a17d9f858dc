import re

import pytest

from helpers import awkward, frame, prose
from tessera.llm import decontaminate as D

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text, bench, size=13):
    w, hit, items = words(text), set(), set()
    for item, t in bench:
        iw = words(t)
        n = min(size, len(iw))
        for i in range(len(iw) - n + 1) if n else ():
            for j in range(len(w) - n + 1):
                if w[j : j + n] == iw[i : i + n]:
                    hit.update(range(j, j + n))
                    items.add(item)
    return len(w), len(hit), sorted(items - {None})


BENCH = [
    (1, prose(50, 30)), (2, prose(51, 13)), (3, "two words"), (4, "Solo"), (5, None), (6, ""), (7, prose(50, 30)), (8, prose(52, 14)),
    (None, "the of"), (9, "x x x x x x x x x x x x x x"),
]
DOCS = awkward() + [
    (20, prose(60, 50) + " " + prose(50, 30).upper() + " " + prose(61, 40)),
    (21, prose(51, 13)), (22, prose(51, 12)), (23, "a two, words b SOLO two"), (24, prose(52, 14)[3:]), (25, "x " * 40),
    (26, prose(50, 30) + "; " + prose(50, 30)),
]


@pytest.mark.parametrize("segment", [500_000, 20])
def test_matches_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(D, "SEGMENT_WORDS", segment)
    if segment == 20:
        monkeypatch.setattr(D, "PART_WORDS", 4)
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = D.find_items(frame(spark, DOCS, extra="items"), bench).collect()
    mine = sorted((r.doc_id or -1, r.n_words, r.n_hit, r["items"]) for r in got)
    assert mine == sorted((d or -1, *brute(t, BENCH)) for d, t in DOCS)
    for r in got:
        assert sum(s.last - s.first + 1 for s in r.spans) == r.n_hit


def test_empty_tables(spark):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert D.find_items(frame(spark, []), bench).count() == 0
    assert D.find_items(frame(spark, DOCS), bench.limit(0)).filter("n_hit > 0").count() == 0


def test_long_items_are_cut_and_words_are_counted_as_they_are_cut(spark, monkeypatch):
    monkeypatch.setattr(D, "PART_WORDS", 100)
    text = ",".join(f"w{i}" for i in range(1000))  # one word to white space
    items = spark.createDataFrame([(1, text), (1, text), (None, "a b"), (2, None), (3, " ")], "item_id long, text string")
    parts = sorted((r.item_id or -1, r.n, bytes(r.words).split()) for r in D.item_parts(items, 13).collect())
    assert [n for _, n, _ in parts] == [2, *sorted([112] * 9 + [100])]
    windows = {tuple(w[i : i + 13]) for _, n, w in parts[1:] for i in range(n - 12)}
    assert len(windows) == 988 == sum(n - 12 for _, n, _ in parts[1:])
