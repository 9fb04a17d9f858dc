import random

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from tessera.operators import als
from tessera.operators import factors as V

FACTORS = "id long, features array<double>"


def tables(spark, users, items):
    u = spark.createDataFrame(users, FACTORS).withColumnRenamed("id", "user_id")
    return u, spark.createDataFrame(items, FACTORS).withColumnRenamed("id", "item_id")


def brute(users, items, seen, n):
    out = []
    for u, f in users:
        if f is not None:
            scored = sorted((-float(np.dot(f, g)), i) for i, g in items if g is not None and (u, i) not in seen)
            out += [(u, r, i, -s) for r, (s, i) in enumerate(scored[:n], 1)]
    return sorted(out)


def made(n_users=60, n_items=400):
    rnd = random.Random(4)
    whole = lambda top: [float(rnd.randrange(-top, top + 1)) for _ in range(3)]
    items = [(i, whole(1 + 200 // (i + 1))) for i in range(n_items)] + [(n_items, None), (n_items + 1, [0.0] * 3)]
    users = [(u, whole(5)) for u in range(n_users)] + [(n_users, [0.0] * 3), (n_users + 1, None)]
    seen = {(rnd.randrange(n_users), rnd.randrange(40)) for _ in range(800)} | {(0, i) for i in range(n_items - 4)} | {(900, 1)}
    return users, items, seen


@pytest.mark.parametrize("band", [16_384, 50])
def test_top_items_equal_brute_force(spark, monkeypatch, band):
    monkeypatch.setattr(V, "BAND", band)
    users, items, seen = made()
    listed = spark.createDataFrame(sorted(seen) + [(0, 0), (0, 0)], "user_id long, item_id long")
    got = V.top_items(*tables(spark, users, items), listed, n=7)
    assert sorted(map(tuple, got.collect())) == brute(users, items, seen, 7)


def test_users_meet_all_bands_in_one_place(spark, monkeypatch):
    """Users are shuffled once, however many bands there are: no pass writes them again."""
    monkeypatch.setattr(V, "BAND", 20)
    monkeypatch.setattr(V, "USERS", 7)
    users, items, seen = made()
    listed = spark.createDataFrame(sorted(seen), "user_id long, item_id long")
    doubled = users + [users[3]]
    got = V.top_items(*tables(spark, doubled, items), listed, n=5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert sorted(map(tuple, got.collect())) == sorted(brute(doubled, items, seen, 5))


def test_equal_lengths_are_dealt_to_bands(spark, monkeypatch):
    monkeypatch.setattr(V, "BAND", 30)
    _, items = tables(spark, [], [(i, [1.0, -1.0]) for i in range(200)])
    sizes = [r["count"] for r in V.banded(items).groupBy("band").count().collect()]
    assert sum(sizes) == 200 and len(sizes) == 7 and max(sizes) < 60


def test_no_users_or_items(spark):
    empty = spark.createDataFrame([], "user_id long, item_id long")
    users, items = tables(spark, [(1, [1.0])], [(1, [1.0])])
    assert V.top_items(users.limit(0), items, empty).count() == 0
    assert V.top_items(users, items.limit(0), empty).count() == 0
    assert [tuple(r) for r in V.top_items(users, items, empty).collect()] == [(1, 1, 1, 1.0)]


def test_short_items_are_skipped():
    rnd = np.random.default_rng(1)
    factors = rnd.normal(size=(20_000, 8)) * np.linspace(5, 0.1, 20_000)[:, None]
    length = np.sqrt((factors**2).sum(1))
    order = np.argsort(-length)
    band = V.Band(np.arange(20_000)[order], factors[order], length[order], -1.0)
    best = V.Best(rnd.normal(size=(100, 8)), np.full((100, 10), 2**62), np.full((100, 10), -np.inf))
    best.meet(band, np.zeros(0, int), np.zeros(0, int))
    want = -np.sort(-(best.features @ factors.T), axis=1)[:, :10]
    assert np.allclose(best.scores, want)
    assert best.met < 0.8 * 100 * 10 and best.asked < 100 * 11


def test_fold_in_solves_the_normal_equations(spark):
    rnd = random.Random(2)
    items = [(i, [rnd.random() for _ in range(4)]) for i in range(20)]
    ratings = [(u, rnd.randrange(25), float(rnd.randrange(1, 6))) for u in range(8) for _ in range(1 + 3 * u)] + [(1, 2, None), (50, 99, 1.0)]
    _, item_table = tables(spark, [], items)
    got = {r.user_id: r.features for r in V.fold_in(spark.createDataFrame(ratings, "user_id long, item_id long, rating double"), item_table, 4, 0.1).collect()}
    by_id = dict(items)
    for u in range(8):
        own = [(np.array(by_id[i]), r) for v, i, r in ratings if v == u and i in by_id and r is not None]
        if own:
            a = sum(np.outer(f, f) for f, _ in own) + 0.1 * len(own) * np.eye(4)
            assert np.allclose(got[u], np.linalg.solve(a, sum(f * r for f, r in own)))
    assert 50 not in got
    with pytest.raises(ValueError):
        V.fold_in(spark.createDataFrame(ratings, "user_id long, item_id long, rating double"), item_table, 4, 0.0)


def test_fold_in_gives_back_what_als_fitted(spark):
    """ALS updates its users last, so they solve the equations for its item factors as they are."""
    ratings = spark.range(600).select((F.col("id") % 20).cast("int").alias("user_id"), (F.col("id") * 7 % 31).cast("int").alias("item_id"), ((F.col("id") * 5 % 9) / 2 + 1).alias("rating"))
    ratings = ratings.dropDuplicates(["user_id", "item_id"])
    model = ALS(rank=3, maxIter=5, regParam=0.1, seed=1, userCol="user_id", itemCol="item_id", ratingCol="rating").fit(ratings)
    folded = V.fold_in(ratings, model.itemFactors.withColumnRenamed("id", "item_id"), 3, 0.1)
    mine = {r.user_id: r.features for r in folded.collect()}
    theirs = {r.id: r.features for r in model.userFactors.collect()}
    assert mine.keys() == theirs.keys()
    assert max(np.abs(np.array(mine[i]) - np.array(theirs[i])).max() for i in mine) < 1e-3


def test_a_new_user_is_served_without_training(spark, tmp_out):
    ratings = spark.range(2400).select((F.col("id") / 40).cast("long").alias("user_id"), (F.col("id") % 40).alias("item_id"), ((F.col("id") * 7 % 9) / 2 + 1).alias("rating"))
    model = als.fit(als.IdMap(ratings).to_int(ratings), 4, 5, 0.1, seed=1)
    profile = spark.createDataFrame([(1, "a", 5), (2, "b", 1), (3, "c", 0)], "item_id long, title string, rating int")
    got = als.recommend_folded(model, profile, n=38, reg=0.1).collect()
    assert sorted(r.item_id for r in got) == [0, *range(3, 40)]
    assert [r.prediction for r in got] == sorted((r.prediction for r in got), reverse=True)
    assert als.recommend_folded(model, profile.where("rating = 0"), n=5).count() == 0
