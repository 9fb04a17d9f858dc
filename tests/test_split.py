import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators import split as S


def key48(*parts):
    return int(hashlib.md5(":".join(["5", *parts]).encode()).hexdigest()[:12], 16)


def test_sides_are_exact_and_by_hash(spark):
    rnd = random.Random(1)
    rows = [(rnd.randrange(40), rnd.randrange(5), float(rnd.randrange(1, 6))) for _ in range(503)]
    df = spark.createDataFrame(rows, "u long, i long, r double")
    for weights in ((0.8, 0.2), (3, 1, 1), (1, 0), (0, 1)):
        got = S.exact_split(df.repartition(3), ["u", "i"], weights, seed=5).collect()
        order = sorted(rows, key=lambda r: (key48(str(r[0]), str(r[1])), key48(str(r[0]), str(r[1]), str(r[2]))))
        ends = [round(503 * sum(weights[: i + 1]) / sum(weights)) for i in range(len(weights))]
        want = Counter((*r, next(s for s, e in enumerate(ends) if at < e)) for at, r in enumerate(order))
        assert Counter(map(tuple, got)) == want


def test_equal_rows_are_split_too(spark):
    df = spark.range(1000).select(F.lit(1).alias("u"), F.lit(None).cast("string").alias("t"))
    got = S.exact_split(df, ["u"], (0.333, 0.667))
    assert sorted(tuple(r) for r in got.groupBy("split").count().collect()) == [(0, 333), (1, 667)]


def test_selection_finds_the_kth(spark):
    values = [random.Random(2).getrandbits(48) for _ in range(300)] + [7] * 20
    df = spark.createDataFrame([(v,) for v in values], "x long")
    ordered = sorted(values)
    for k in (1, 5, 20, 21, 160, 320):
        v = ordered[k - 1]
        assert S.smallest(df, "x", k) == (v, sum(x < v for x in values), values.count(v))
    with pytest.raises(ValueError):
        S.smallest(df, "x", 321)


def test_empty_table(spark):
    assert S.exact_split(spark.range(0), ["id"]).count() == 0
