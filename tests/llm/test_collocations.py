import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import prose

from tessera.llm import collocations as C

SCHEMA = "doc_id long, lang string, text string"


def phrases(text, longest):
    lower = {c: c + 32 for c in range(65, 91)}
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
        words = re.findall(r"[^\x20\x09]+", piece)
        for k in range(1, longest + 1):
            yield from (tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows, least, longest=4, share=80, top=2000):
    count = defaultdict(Counter)
    for _, lang, text in rows:
        count["und" if lang is None else lang].update(phrases(text, longest))
    out = []
    for lang, f in count.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in cands.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and 100 * a >= share * cands[p[i:j]]:
                        covered.add(p[i:j])
        scored = []
        for p, a in cands.items():
            if p not in covered:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def mixed():
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["en", "en", "fr", None, "und", ""]), prose(i, rnd.randrange(60))) for i in range(80)]
    rows += [rows[0], rows[0], (90, "en", None), (None, "en", ""), (91, "de", " .,;\n\r\x0b\x0c\t! "), (92, "de", "a a a a a\ta  A, a a\x1ca")]
    rows += [(93, "fr", prose(7, 20_000)), (94, "en", "new york city. New York! " * 9 + "\x85 x\x00y " * 5), (95, "zz", "one two")]
    return rows


def got(spark, rows, **args):
    found = C.collocations(spark.createDataFrame(rows, SCHEMA), **args)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in found.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("least, top", [(3, 2000), (12, 6), (10**6, 2000)])
def test_collocations_equal_brute_force(spark, least, top):
    assert got(spark, mixed(), least=least, top=top) == brute(mixed(), least, top=top)


def test_small_pieces_change_nothing(spark, monkeypatch):
    rows = mixed()[:70]
    monkeypatch.setattr(C, "PIECE", 12)
    monkeypatch.setattr(C, "BLOCK", 2)
    assert got(spark, rows, least=4) == brute(rows, 4)


def test_empty_table_and_clashing_columns(spark):
    assert got(spark, [], least=1) == []
    rows = [(1, "en", "a b a b"), (2, "en", "a b c")]
    plain = spark.createDataFrame(rows, SCHEMA)
    clashing = plain.selectExpr("*", "1 as n", "2 as phrase", "3 as key", "'q' as word", "4 as number")
    assert sorted(C.collocations(clashing, least=2).collect()) == sorted(C.collocations(plain, least=2).collect())


def ways(pairs, lo, hi, first, n_words=3000):
    state, word = (np.array(c, np.int64) for c in zip(*sorted(pairs), strict=True))
    return C.ways_of(state, word, n_words, lo, hi, first)


def test_double_array_holds_its_ways_and_no_others():
    rnd = random.Random(8)
    pairs = {(rnd.randrange(100, 160), int(rnd.paretovariate(0.7)) % 3000) for _ in range(2500)} | {(199, 0), (199, 2999)}
    trie = ways(pairs, 100, 200, 5000)
    want = {p: 5000 + i for i, p in enumerate(sorted(pairs))}
    state, word = (c.ravel() for c in np.meshgrid(np.arange(90, 210), np.arange(-1, 3000), indexing="ij"))
    reached = C.step(trie, state, word)
    assert {(int(s), int(w)): int(t) for s, w, t in zip(state, word, reached, strict=True) if t >= 0} == want
    assert len(trie.check) < 2 * len(pairs) + 1500
    for n_words in (1, 200, 256, 257, 70_000, 2**24 + 1):
        pairs = {(5, 0), (5, n_words - 1), (6, n_words // 2), (9, n_words - 1)}
        trie = ways(pairs, 5, 10, 100, n_words)
        got = [C.step(trie, np.array([s]), np.array([w]))[0] for s, w in sorted(pairs)]
        assert got == list(range(100, 100 + len(pairs))) and C.step(trie, np.array([7]), np.array([0]))[0] == -1


class Piece:
    """Stands for a broadcast value that a worker reads again when it has let it go."""

    def __init__(self, value):
        self.stored, self.reads = value, 0

    @property
    def value(self):
        if "_value" not in vars(self):
            self._value, self.reads = self.stored, self.reads + 1
        return self._value


def test_many_pieces_are_held_one_at_a_time(monkeypatch):
    monkeypatch.setattr(C, "KEEP", 1)
    books = [Piece({"en": {b"a": 0, b"b": 1}}), Piece({"en": {b"c": 2}, "fr": {b"a": 3}})]
    numbers = C.numbers_of(["en", "fr", "en"], [b"A b c, a x", b"a b", b""], books)
    assert numbers.tolist() == [0, 1, 2, -1, 0, -1, -1, 3, -1, -1, -1]
    levels = [[Piece(ways([(0, 1)], 0, 1, 4)), Piece(ways([(1, 2), (3, 3)], 1, 4, 5))], [Piece(ways([(4, 2)], 4, 5, 7)), Piece(ways([(5, 0)], 5, 6, 8))]]
    states = [s.tolist() for s in C.reached(numbers, levels)]
    assert states[1][:3] == [4, 5, -1] and states[2][:2] == [7, -1]
    assert not any("_value" in vars(p) for p in [*books, *(p for level in levels for p in level)])


def test_scores_beyond_64_bits_stay_exact(spark):
    row = spark.createDataFrame([(9 * 10**17, 10**18, 2 * 10**18)], "a long, l long, r long")
    score = row.selectExpr("(cast(2000000 as decimal(18,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + r)").first()[0]
    assert score == 2_000_000 * 9 * 10**17 // (3 * 10**18)
