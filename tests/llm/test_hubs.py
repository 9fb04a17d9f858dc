"""Hot keys: components with a hub, joins back of per-key values, spanning edges; refinement against plain strings."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import common, jaccard, repeats
from tessera.llm import components as cc
from tessera.llm.components import components


def least_of(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


def test_spanning_connects_the_same():
    rng = np.random.default_rng(5)
    for n, m in ((1, 0), (6, 4), (50, 40), (400, 380), (300, 2000)):
        a, b = rng.integers(0, n, m) * 7, rng.integers(0, n, m) * 7
        root, other = jaccard.spanning(a[a != b], b[a != b])
        want = least_of(zip(a[a != b].tolist(), b[a != b].tolist(), strict=True))
        assert dict(zip(other.tolist(), root.tolist(), strict=True)) == {x: r for x, r in want.items() if x != r}
    chain = np.random.default_rng(1).permutation(3000)
    root, other = jaccard.spanning(chain[:-1], chain[1:])
    assert (root == 0).all() and len(other) == 2999


def test_components_with_a_hub(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_KEYS", 8)
    rng = random.Random(3)
    edges = [(17, 1000 + i) for i in range(400)]  # a third on one node
    edges += [(5000 + i, 5001 + i) for i in range(60)] + [(rng.randrange(2000, 3000), rng.randrange(2000, 3000)) for _ in range(700)]
    edges += [(17, 17), (5000, 17), (1003, 17)]
    got = components(spark.createDataFrame(edges + [(None, 3), (4, None)], "a long, b long")).collect()
    want = {x: r for x, r in least_of((a, b) for a, b in edges if a != b).items()}
    assert len(got) == len(want) and {r.node: r.component for r in got} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stars_end_without_a_round(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(cc, "written", lambda df, tag: tables.append(tag) or common.written(df, tag))
    edges = [(10 * k + i, 10 * k) for k in range(30) for i in range(1, 8)]
    got = cc.components(spark.createDataFrame(edges + [(b, a) for a, b in edges], "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((10 * k + i, 10 * k) for k in range(30) for i in range(8))
    assert len(tables) == 2


def test_meetings_give_stars(spark):
    sets = [(1, 9 - i, 9 - i, 0, np.arange(100 + i, dtype="<u8").tobytes()) for i in range(6)]
    meetings = spark.createDataFrame(sets, "meeting long, class long, joined long, side int, shingles binary")
    assert sorted(map(tuple, jaccard.verify(meetings, 90).collect())) == [(4, 5 + i) for i in range(5)]


def test_documents_of_a_block_go_to_several_slices(spark):
    docs = spark.range(2000).coalesce(1).selectExpr("id as doc_id", "concat('a b ', id) as text")
    rows = jaccard.sketch_blocks(docs, 3, 90, 16).where("kind = 0").groupBy("slice").count().collect()
    assert len(rows) == 8 and max(r["count"] for r in rows) == jaccard.PLAIN


def test_joined_back_keeps_every_row(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_KEYS", 4)
    rows = spark.createDataFrame([(i % 3 if i % 2 else 77, i) for i in range(300)] + [(100 + i, i) for i in range(20)], "k long, v long")
    per_key = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = common.joined_back(rows, per_key, ["k"], F.col("n"), rows.count())
    assert sorted(map(tuple, got.select("k", "v", "n").collect())) == sorted(map(tuple, rows.join(per_key, "k").select("k", "v", "n").collect()))


def test_refinement_finds_equal_strings():
    rng = random.Random(9)
    for size, q in ((40, 20), (12, 6), (9, 8), (30, 10)):
        core = [bytes(rng.choice(b"ab") for _ in range(q)) for _ in range(3)]
        rows = []
        for _ in range(60):
            k = rng.randrange(3)
            left, right = rng.randint(0, size - q), rng.randint(0, size - q)
            fill = bytes([rng.choice((0, 97, 255))]) * (left + right) if rng.random() < 0.5 else bytes(rng.choice(b"\x00ab") for _ in range(left + right))
            rows.append((k, left + rng.randrange(50), left, right, rng.choice((1, 1, 2)), fill[:left] + core[k] + fill[left:]))
        bucket, at, left, right, weight, text = (list(c) for c in zip(*rows, strict=True))
        got = repeats.refine(*(np.array(c, np.int64) for c in (bucket, at, left, right, weight)), text, size, q)
        times: dict = {}
        for k, _, le, _, w, c in rows:
            for i in range(len(c) - size + 1):
                times[k, le - i, c[i : i + size]] = times.get((k, le - i, c[i : i + size]), 0) + w
        want = {
            (j, a - le + i, a - le + i + size)
            for j, (k, a, le, _, _, c) in enumerate(rows)
            for i in range(len(c) - size + 1)
            if times[k, le - i, c[i : i + size]] > 1
        }
        assert set(map(tuple, got.T.tolist())) == want
