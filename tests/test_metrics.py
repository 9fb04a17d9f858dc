import random

from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import metrics, prefix


def _brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auc_matches_brute_force(spark):
    rnd = random.Random(1)
    pairs = [(float(rnd.randint(0, 1)), float(rnd.randint(0, 40))) for _ in range(800)]  # many ties
    df = spark.createDataFrame(pairs, "label double, score double")
    for buckets in (1, 4, 64):
        r = metrics.auc(df, buckets=buckets).first()
        assert abs(r.auc - _brute_auc(pairs)) < 1e-12
        assert r.n_pos + r.n_neg == 800


def test_auc_matches_evaluator(spark):
    rnd = random.Random(2)
    pairs = [(float(rnd.randint(0, 1)), rnd.random()) for _ in range(500)]
    df = spark.createDataFrame(pairs, "label double, score double")
    mine = metrics.auc(df).first().auc
    vec = df.select("label", F.array(-F.col("score"), F.col("score")).alias("raw"))
    from pyspark.ml.functions import array_to_vector

    ev = metrics.auc_evaluator(vec.select("label", array_to_vector("raw").alias("rawPrediction")))
    assert abs(mine - ev) < 1e-9


def test_mse_and_join(spark):
    actual = spark.createDataFrame([(1, 1, 4.0), (1, 2, 3.0), (2, 1, 5.0), (2, 1, 5.0)], "user_id long, item_id long, rating double")
    pred = spark.createDataFrame([(1, 1, 3.5), (2, 1, 4.0)], "user_id long, item_id long, prediction double")
    j = metrics.join_predictions(actual, pred)
    assert j.count() == 3  # (1,2) has no prediction; duplicate (2,1) rows both kept
    r = metrics.mse(j).first()
    assert abs(r.mse - (0.25 + 1 + 1) / 3) < 1e-12 and r.n == 3


def test_running_sum_and_dense_index(spark):
    rnd = random.Random(3)
    vals = rnd.sample(range(100000), 3000)
    df = spark.createDataFrame([(v, v % 7) for v in vals], "k long, w long")
    got = dict(rows(prefix.running_sum_below(df, "k", "w", "below", buckets=16), "k", "below"))
    acc, want = 0, {}
    for v in sorted(vals):
        want[v] = acc
        acc += v % 7
    assert got == want
    idx = dict(rows(prefix.dense_index(df.union(df), "k", buckets=16), "k", "idx"))
    assert idx == {v: i for i, v in enumerate(sorted(vals))}


def test_auc_of_very_large_counts(spark):
    from tessera.operators.metrics import auc_of_counts

    n = 3 * 10**9
    counts = spark.createDataFrame([(0.1, 0, n, 0), (0.5, n, n, n), (0.9, n, 0, 2 * n)], "score double, _p long, _q long, _below long")
    row = auc_of_counts(counts).first()
    assert abs(row.auc - (1 * 1.5 / 2 + 1 * 2 / 2) / 2) < 1e-12
    assert (row.n_pos, row.n_neg) == (2 * n, 2 * n)


def test_auc_leaves_out_rows_without_a_label(spark):
    df = spark.createDataFrame([(1.0, 0.9), (0.0, 0.1), (None, 0.5), (1.0, None)], "label double, score double")
    row = metrics.auc(df).first()
    assert (row.auc, row.n_pos, row.n_neg) == (1.0, 1, 1)
