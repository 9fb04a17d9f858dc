import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import als
from tessera.operators import als_slices as S


def _ratings(spark, parts=3):
    rows = [(u - 20, i, float(1 + (u * 7 + i * i) % 9) / 2) for u in range(50) for i in range(30) if (u * 13 + i * 5) % 7 < 1 + u % 5]
    rows += rows[:40]  # pairs that come twice
    return spark.createDataFrame(rows, "user_id int, item_id int, rating double").repartition(parts)


def _factors(table):
    return {r.id: np.array(r.features, dtype=float) for r in table.collect()}


def _fixed(rows, rank, reg, own, other, of, by):
    for key in own:
        mine = [r for r in rows if r[of] == key]
        v, r = np.array([other[x[by]] for x in mine]), np.array([x.rating for x in mine])
        want = np.linalg.solve(v.T @ v + reg * len(mine) * np.eye(rank), v.T @ r)
        assert np.allclose(own[key], want, rtol=1e-4, atol=1e-4)


@pytest.mark.parametrize("rank", [3, 20])
def test_users_solve_their_systems(spark, rank, monkeypatch):
    monkeypatch.setattr(S, "DEAL", 100)
    monkeypatch.setattr(S, "PIECE", 50)
    r = _ratings(spark)
    with S.sliced(r, r.count()) as s:
        m = S.Course(s, als.estimator(rank, 9, 0.1, 1)).to(4)
        users, items = _factors(m.userFactors), _factors(m.itemFactors)
    rows = r.collect()
    assert set(users) == {x.user_id for x in rows} and set(items) == {x.item_id for x in rows}
    _fixed(rows, rank, 0.1, users, items, "user_id", "item_id")


def test_many_ratings_are_fitted_on_slices(spark, monkeypatch):
    r = _ratings(spark)
    spark_mse = als.evaluate_mse(als.fit(r, 4, 15, 0.05, seed=1), r).first()
    monkeypatch.setattr(als, "SMALL", 100)
    monkeypatch.setattr(als.ALS, "fit", lambda *a, **k: pytest.fail("Spark's ALS"))
    model = als.fit(r, 4, 15, 0.05, seed=1)
    own = als.evaluate_mse(model, r).first()
    assert own.n == spark_mse.n and own.mse == pytest.approx(spark_mse.mse, rel=0.2)
    cold = spark.createDataFrame([(999, 1, 1.0), (1, 999, 1.0)], "user_id int, item_id int, rating double")
    assert model.transform(cold).count() == 0 and model.rank == 4


def test_a_side_that_no_task_can_hold_is_left_to_spark(spark, monkeypatch):
    monkeypatch.setattr(als, "SMALL", 100)
    monkeypatch.setattr(S, "HELD", 100)
    monkeypatch.setattr(S, "sliced", lambda *a, **k: pytest.fail("sliced"))
    assert als.fit(_ratings(spark), 2, 1, 0.1).rank == 2
    monkeypatch.setattr(S, "HELD", 10**9)
    assert als.fit(_ratings(spark), 2, 1, 0.0001).rank == 2  # nor are sums in 32 bits for such a λ


def test_model_does_not_depend_on_the_slices(spark, monkeypatch):
    monkeypatch.setattr(als, "SMALL", 100)
    a = _factors(als.fit(_ratings(spark), 3, 4, 0.1, seed=9).userFactors)
    monkeypatch.setattr(S, "SLICE", 40)
    b = _factors(als.fit(_ratings(spark, 5), 3, 4, 0.1, seed=9).userFactors)
    assert a.keys() == b.keys() and all(np.allclose(a[u], b[u], rtol=1e-4, atol=1e-5) for u in a)


def test_a_grid_fits_on_from_fewer_iterations(spark, tmp_out, monkeypatch):
    monkeypatch.setattr(als, "SMALL", 100)
    r, steps = _ratings(spark), []
    configs = [(2, 5, 0.1), (3, 2, 0.1), (2, 2, 0.1), (2, 5, 1.0), (2, 5, 0.1)]
    each = [als.evaluate_mse(als.fit(r, *c, seed=1), r).first() for c in configs]
    half = S.half
    monkeypatch.setattr(S, "half", lambda reg: steps.append(reg) or half(reg))
    got = als.grid_report(r, r, configs, seed=1, model_dir=f"{tmp_out}/m").collect()
    assert [(x.rank, x.iteration, x["lambda"]) for x in got] == configs
    assert [(x.mse, x.n) for x in got] == [(pytest.approx(e.mse, rel=1e-5), e.n) for e in each]
    assert len(steps) == 4  # asked for a model four times, and each time went on
    monkeypatch.setattr(S.Course, "to", lambda *a: pytest.fail("fitted again"))
    assert [x.mse for x in als.grid_report(r, r, configs, seed=1, model_dir=f"{tmp_out}/m").collect()] == pytest.approx([x.mse for x in got])


def test_steps_shuffle_nothing_and_drop_what_they_leave(spark):
    r = _ratings(spark)
    with S.sliced(r, r.count()) as s:
        course = S.Course(s, als.estimator(2, 9, 0.1, 1))
        course.to(1)
        before, old = set(spark.sparkContext._jsc.getPersistentRDDs().keySet()), course.users.getCheckpointFile()
        assert "Shuffled" not in S.beside(s._items, course.users)._jrdd.rdd().toDebugString().split("CachedPartitions")[0]
        course.to(4)
        assert len(set(spark.sparkContext._jsc.getPersistentRDDs().keySet())) == len(before)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old)
        assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        course.drop()


@pytest.mark.parametrize("rating", [None, float("nan"), float("inf")])
def test_ratings_that_are_no_numbers_raise(spark, rating):
    r = _ratings(spark).union(spark.createDataFrame([(1, 1, rating)], "user_id int, item_id int, rating double"))
    with pytest.raises(Exception, match="MUST NOT be"):
        S.Slices(r, 100)


@pytest.mark.parametrize("rank", [2, 8, 30])
def test_solved_whatever_the_number_of_ratings(rank, monkeypatch):
    monkeypatch.setattr(S, "GATHERED", 16)
    monkeypatch.setattr(S, "SUMS", 1)
    rng = np.random.default_rng(3)
    other = rng.standard_normal((90, rank)).astype(np.float32)
    counts = np.sort(np.r_[np.ones(70), 2, 3, 3, 7, 16, 17, 33, 80]).astype(np.int32)
    rows = S.Rows((0, 0), np.arange(len(counts)), counts, rng.integers(0, 90, counts.sum()).astype(np.int32), rng.random(counts.sum()).astype(np.float32))
    got, end = S.solved(rows, other, 0.05), np.cumsum(counts)
    for x, n, e in zip(got, counts, end, strict=True):
        v, r = other[rows.others[e - n : e]].astype(float), rows.ratings[e - n : e]
        assert np.allclose(x, np.linalg.solve(v.T @ v + 0.05 * n * np.eye(rank), v.T @ r), rtol=1e-3, atol=1e-4)
    with pytest.raises(np.linalg.LinAlgError):
        S.solved(rows, other, -9.0)
