import random
from collections import Counter, defaultdict

import pytest

from tessera.operators import heavy as H


def brute(rows, k):
    by = defaultdict(Counter)
    for g, v in rows:
        if g is not None and v is not None:
            by[g][v] += 1
    out = []
    for g, counts in by.items():
        out += [(g, i, v, n) for i, (v, n) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k], 1)]
    return sorted(out)


def skewed(n=4000, seed=3):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["a", "a", "b"]), f"t{int(rnd.paretovariate(0.6)) % 900}") for _ in range(n)]
    return rows + [("c", "only"), (None, "x"), ("a", None)] + [("flat", f"f{i}") for i in range(300)]


@pytest.mark.parametrize("capacity", [5, 12, 40, 1024])
def test_most_frequent_equals_brute_force(spark, capacity):
    """Small summaries drop values and leave groups in doubt, which are done again."""
    rows = skewed()
    df = spark.createDataFrame(rows, "g string, v string").repartition(5)
    got = H.most_frequent(df, "g", "v", k=5, capacity=capacity)
    assert got.columns == ["g", "rank", "v", "n"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)


def test_a_summary_is_bounded_and_never_off_by_more_than_its_error():
    rnd = random.Random(4)
    values = [int(rnd.paretovariate(0.5)) for _ in range(20_000)]
    s = H.Summary(50)
    for v in values:
        s.add(v)
        assert len(s.counts) <= 100
    true = Counter(values)
    assert s.error <= len(values) / 50
    assert all(0 <= n - s.counts.get(v, 0) <= s.error for v, n in true.items())
    assert all(v in true for v in s.counts)


def test_summaries_do_not_grow_with_the_vocabulary(spark):
    df = spark.range(50_000, numPartitions=4).selectExpr("'g' as g", "if(id % 3 = 0, 'hot', cast(id as string)) as v")
    found = H.summaries(df, "g", "v", 16)
    assert found.where("v is not null").count() <= 4 * 32
    assert [tuple(r) for r in H.most_frequent(df, "g", "v", k=1, capacity=16).collect()] == [("g", 1, "hot", 16_667)]


def test_empty_and_too_small(spark):
    df = spark.createDataFrame([], "g string, v string")
    assert H.most_frequent(df, "g", "v").count() == 0
    with pytest.raises(ValueError):
        H.most_frequent(df, "g", "v", k=10, capacity=5)
