import random
from collections import Counter

import numpy as np
import pytest

from helpers import awkward, documents, frame, prose
from tessera.llm import jaccard as J
from tessera.llm.components import components


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k, percent):
    """component of each row number."""
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        least[r] = min([x for x in (least.get(r), d) if x is not None], default=None)
    return [(d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)]


def family(seed, n, copies, edits):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(5000)}" for _ in range(n)]
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def corpus():
    texts = [t for s, (n, c, e) in enumerate([(150, 40, 12), (60, 12, 3), (20, 10, 1), (400, 6, 30), (12, 5, 1), (9, 4, 1)]) for t in family(s, n, c, e)]
    return awkward() + [(100 + i, t) for i, t in enumerate(texts)] + [(900, texts[0]), (5, texts[3])]


def key(r):
    return tuple(-1 if v is None else v for v in r)


@pytest.mark.parametrize("words,percent,block", [(3, 90, 256), (5, 80, 256), (3, 70, 4)])
def test_matches_brute_force(spark, monkeypatch, words, percent, block):
    monkeypatch.setattr(J, "BLOCK", block)  # small blocks take the second round
    monkeypatch.setattr(J, "SLICE_TEXT", 20_000)
    got = J.near_duplicates(frame(spark, corpus(), extra="n_shingles"), words, percent).collect()
    assert sorted(key((r.doc_id, r.n_shingles, r.component_id)) for r in got) == sorted(map(key, brute(corpus(), words, percent)))


def test_one_of_each(spark):
    rows = corpus()
    kept = J.one_of_each(documents(spark, rows)).collect()
    want = Counter(c for _, n, c in brute(rows, 5, 80) if n)
    assert Counter(r.doc_id for r in kept if shingles(r.text, 5)) == Counter(want.keys())
    assert sum(not shingles(r.text, 5) for r in kept) == sum(n == 0 for _, n, _ in brute(rows, 5, 80))


def test_linked_sets_always_share_a_key():
    rnd = np.random.default_rng(3)
    for percent in (80, 90):
        bands = J.Bands(percent)
        for n in (3, 8, 9, 10, 14, 15, 40, 333, 2000):
            for _ in range(10):
                a = np.unique(J.mix(rnd.integers(0, 2**62, n, dtype=np.uint64)))
                drop = int(len(a) * (100 - percent) / 100)
                b = np.sort(rnd.choice(a, len(a) - drop, replace=False))
                assert 100 * len(b) >= percent * len(a)
                assert np.intersect1d(bands.keys(a), bands.keys(b)).size


def test_hamming_never_above_the_difference():
    rnd = np.random.default_rng(4)
    for n in (5, 100, 5000):
        a = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[n // 3 :], rnd.integers(0, 2**63, n // 4 + 1, dtype=np.uint64)]))
        apart = int(np.bitwise_count(J.parity(a) ^ J.parity(b)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_empty_table(spark):
    assert J.near_duplicates(frame(spark, [])).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100 + i, 100) for i in range(1, 50)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {200: 200, 201: 200}


def test_large_families_are_cut_finer(spark):
    """Sets that share a passage, and little else, don't meet; linked ones do, also such that share no rare shingle of their own."""
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 2**63, 30).astype(np.uint64)
    own = [rng.integers(0, 2**63, 70).astype(np.uint64) for _ in range(40)]
    sets = [np.append(passage, x) for x in own]
    sets[7] = np.append(passage, np.append(own[6][:65], own[7][:5]))  # a pair
    sets += [np.append(passage, own[0][:2])]  # nothing but the passage, nearly: its partner as well
    sets += [np.append(passage, own[1][:2])]
    rows = [(i, 0 if i != 9 else 1, np.unique(s).tobytes()) for i, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "class long, family long, shingles binary")
    got = {r["class"]: r.family for r in J.finer(frame, 80).collect()}
    assert got == {6: 6, 7: 6, 40: 40, 41: 40}
    assert J.finer(frame.where("class < 5"), 80).count() == 0


@pytest.mark.parametrize("hot_keys", [1, 40, 10_000])
def test_finer_keeps_every_link(spark, monkeypatch, hot_keys):
    """Linked sets stay in one family, whichever shingles count as hot: none, some or all that are shared."""
    monkeypatch.setattr(J, "HOT_KEYS", hot_keys)
    rng = np.random.default_rng(5)
    common = rng.integers(0, 2**63, 40).astype(np.uint64)
    sets = []
    for i in range(90):
        if i % 3 == 0:
            base = np.append(common[: rng.integers(0, 40)], rng.integers(0, 2**63, rng.integers(1, 60)).astype(np.uint64))
        keep = base[rng.random(len(base)) < rng.choice([0.85, 0.95, 1])]
        sets.append(np.unique(np.append(keep, rng.integers(0, 2**63, rng.integers(1, 6)).astype(np.uint64))))
    rows = [(i, i % 2 if i > 80 else 0, s.tobytes()) for i, s in enumerate(sets)]
    got = {r["class"]: r.family for r in J.finer(spark.createDataFrame(rows, "class long, family long, shingles binary"), 80).collect()}
    linked = 0
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if rows[i][1] == rows[j][1] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                linked += 1
                assert got[i] == got[j]
    assert linked > 20 and len(set(got.values())) > 10


def test_copies_leave_no_row_for_each_shingle(spark, monkeypatch):
    """Shingles that many near copies hold are settled by batch, and sets of shingles of their own go before."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, 200).astype(np.uint64)
    sets = [np.append(base, rng.integers(0, 2**63, 3).astype(np.uint64)) for _ in range(100)]
    sets += [np.append(base[:60], rng.integers(0, 2**63, 140).astype(np.uint64)) for _ in range(100)]
    rows = [(i, 0, np.unique(s).tobytes()) for i, s in enumerate(sets)]
    made, plain = {}, J.written
    monkeypatch.setattr(J, "written", lambda df, tag: made.setdefault(tag, plain(df, tag)))
    got = J.finer(spark.createDataFrame(rows, "class long, family long, shingles binary").coalesce(1), 80).collect()
    assert {r["class"]: r.family for r in got} == {i: 0 for i in range(100)}
    assert made["jaccard-tokens"].count() < 1000 and made["jaccard-first"].count() < 1000


def test_pools_of_a_common_passage(spark, monkeypatch):
    """Texts that share a passage of a third fill no pools of the second round."""
    monkeypatch.setattr(J, "BLOCK", 8)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(9))
    passage = " ".join(word() for _ in range(60))
    texts = [f"{passage} {' '.join(word() for _ in range(60))}" for _ in range(120)]
    texts += [f"{t} {word()}" for t in texts[:30]]
    made, plain = [], J.written
    monkeypatch.setattr(J, "written", lambda df, tag: made.append((tag, out := plain(df, tag))) or out)
    got = {r.doc_id: r.component_id for r in J.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5, 80).collect()}
    assert got == {i: i if i < 120 else i - 120 for i in range(150)}
    assert sum(df.count() for tag, df in made if tag == "jaccard-placed") == 0
