import threading
import time

import pytest

from tessera.plans.pool import pooled


def test_results_keep_their_order_and_calls_are_bounded(spark):
    running, most, lock = 0, 0, threading.Lock()

    def one(x):
        nonlocal running, most
        with lock:
            running += 1
            most = max(most, running)
        time.sleep(0.05 * (x % 3))
        n = spark.range(x).count()
        with lock:
            running -= 1
        return n

    assert pooled(spark, one, [5, 3, 9, 1, 7, 2], 3) == [5, 3, 9, 1, 7, 2]
    assert 1 < most <= 3


def test_errors_are_raised_and_the_rest_is_dropped(spark):
    done = []

    def one(x):
        if x == 1:
            raise KeyError("no")
        time.sleep(0.05)
        done.append(x)

    with pytest.raises(KeyError):
        pooled(spark, one, list(range(1, 30)), 2)
    assert len(done) < 10


def test_local_properties_are_inherited(spark):
    sc = spark.sparkContext
    sc.setLocalProperty("tessera.test", "here")
    try:
        assert pooled(spark, lambda _: sc.getLocalProperty("tessera.test"), [1, 2], 2) == ["here", "here"]
    finally:
        sc.setLocalProperty("tessera.test", None)


def test_a_pooled_grid_equals_one_fit_after_another(spark):
    from test_als import _ratings

    from tessera.operators import als
    from tessera.operators import ratings as R

    train, test = R.hash_split(als.IdMap(_ratings(spark)).to_int(_ratings(spark)), ["user_id", "item_id"], (0.8, 0.2), seed=5)
    configs = [(2, 2, 0.1), (3, 2, 0.1), (2, 3, 10.0)]
    alone, pool = (als.grid_report(train, test, configs, parallelism=p).collect() for p in (1, 3))
    assert [(r["rank"], r["iteration"], r["lambda"], r["n"]) for r in alone] == [(r["rank"], r["iteration"], r["lambda"], r["n"]) for r in pool]
    assert all(abs(a["mse"] - b["mse"]) < 1e-6 for a, b in zip(alone, pool))
