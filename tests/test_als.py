import pytest
from pyspark.sql import functions as F

from tessera.operators import als
from tessera.operators import ratings as R
from tessera.sources.models import fit_or_load


def _ratings(spark, n_users=60, n_items=40):
    return spark.range(n_users * n_items).select(
        (F.col("id") / n_items).cast("long").alias("user_id"),
        (F.col("id") % n_items).alias("item_id"),
        ((F.col("id") * 7 % 9) / 2 + 1).cast("double").alias("rating"),
    )


def test_fit_and_mse_finite(spark):
    r = _ratings(spark)
    train, test = R.hash_split(r, ["user_id", "item_id"], (0.8, 0.2), seed=5)
    ids = als.IdMap(r)
    assert not ids.dense
    model = als.fit(ids.to_int(train), 4, 5, 0.1, seed=1)
    m = als.evaluate_mse(model, ids.to_int(test)).first()
    assert m.n > 0 and 0 <= m.mse < 100


def test_collapse_invariant(spark):
    """With a huge λ the factors shrink to 0 and MSE → mean squared target."""
    r = _ratings(spark)
    model = als.fit(als.IdMap(r).to_int(r), 4, 5, 1e6, seed=1)
    mse = als.evaluate_mse(model, als.IdMap(r).to_int(r)).first().mse
    target = r.select(F.avg(F.col("rating") * F.col("rating"))).first()[0]
    assert abs(mse - target) / target < 1e-3


def test_dense_ids_for_wide_keys(spark):
    r = _ratings(spark).withColumn("user_id", F.col("user_id") + F.lit(10**12))
    ids = als.IdMap(r)
    assert ids.dense
    mapped = ids.to_int(r)
    assert mapped.agg(F.max("user_id")).first()[0] == 59
    assert mapped.count() == r.count()


def test_recommend_new_user_excludes_seen(spark):
    r = _ratings(spark)
    items = spark.range(40).select(F.col("id").alias("item_id"), F.concat(F.lit("t"), F.col("id")).alias("title"))
    prof = spark.createDataFrame([(1, "t1", 5), (2, "t2", 4), (3, "t3", 0)], "item_id long, title string, rating int")
    rec = als.recommend_new_user(r, prof, -1, items, n=10, rank=4, max_iter=5, reg=0.1, seed=1)
    got = [x.item_id for x in rec.collect()]
    assert len(got) == 10 and not ({1, 2} & set(got))
    assert rec.columns == ["item_id", "prediction", "title"]


def test_grid_report_and_fit_or_load(spark, tmp_out):
    r = _ratings(spark)
    ids = als.IdMap(r)
    train, test = R.hash_split(ids.to_int(r), ["user_id", "item_id"], (0.8, 0.2), seed=5)
    rep = als.grid_report(train, test, [(2, 3, 0.1), (3, 3, 1.0)], seed=1, model_dir=f"{tmp_out}/models")
    got = rep.collect()
    assert [x.label for x in got] == ["Rank2Iteration3Lambda0.10", "Rank3Iteration3Lambda1.00"]
    assert als.best_config(rep).count() == 1
    calls = []
    again = fit_or_load(f"{tmp_out}/models/{als.model_key(2, 3, 0.1, 'user', 1)}", lambda: calls.append(1), als.ALSModel.load)
    assert not calls and again.rank == 2


@pytest.mark.parametrize("cfg", [als.grid_configs()])
def test_reference_grid(cfg):
    assert len(cfg) == 12 and cfg[0] == (8, 20, 0.01)


def test_same_seed_same_model(spark):
    r = _ratings(spark)
    data = als.IdMap(r).to_int(r)
    a = als.fit(data, 3, 4, 0.1, seed=9).userFactors.orderBy("id").collect()
    b = als.fit(data.repartition(5), 3, 4, 0.1, seed=9).userFactors.orderBy("id").collect()
    assert [x.id for x in a] == [x.id for x in b]
    for x, y in zip(a, b):
        assert max(abs(p - q) for p, q in zip(x.features, y.features)) < 1e-6


def test_two_normalisations_share_a_folder(spark, tmp_out):
    r = _ratings(spark)
    got = {}
    for how in ("none", "max", "none"):
        data = R.normalize(r, how)
        train, test = R.hash_split(als.IdMap(r).to_int(data), ["user_id", "item_id"], (0.8, 0.2), seed=5)
        rep = als.grid_report(train, test, [(2, 3, 0.1)], seed=1, model_dir=f"{tmp_out}/m", normalization=how)
        got.setdefault(how, []).append(rep.first().mse)
    assert got["none"][0] == pytest.approx(got["none"][1]) and got["max"][0] < got["none"][0]


def test_a_broken_saved_model_is_not_overwritten(spark, tmp_out):
    spark.createDataFrame([("not a model",)], "value string").write.text(f"{tmp_out}/m/metadata")
    with pytest.raises(Exception):
        fit_or_load(f"{tmp_out}/m", lambda: pytest.fail("fitted"), als.ALSModel.load)
    assert spark.read.text(f"{tmp_out}/m/metadata").first().value == "not a model"


def test_second_recommendation_trains_nothing(spark, tmp_out, monkeypatch):
    r = _ratings(spark)
    prof = spark.createDataFrame([(1, "t1", 5), (2, "t2", 4)], "item_id long, title string, rating int")
    kw = dict(n=5, rank=3, max_iter=3, reg=0.1, seed=1, model_path=f"{tmp_out}/model")
    first = als.recommend_new_user(r, prof, -1, **kw).collect()
    monkeypatch.setattr(als, "fit", lambda *a, **k: pytest.fail("trained again"))
    assert als.recommend_new_user(r, prof, -1, **kw).collect() == first and len(first) == 5


def test_factors_carry_the_original_ids(spark):
    r = _ratings(spark).withColumn("user_id", F.col("user_id") + F.lit(10**12))
    ids = als.IdMap(r)
    model = als.fit(ids.to_int(r), 2, 2, 0.1, seed=1)
    got = {x.id for x in ids.user_from_int(model.userFactors, "id").collect()}
    assert got == {10**12 + i for i in range(60)}


def test_blocks_follow_the_rows():
    assert als.block_count(1000) == 10
    assert als.block_count(10**10) == 317


def test_an_iteration_sends_few_copies_of_the_factors():
    # both factor tables go to every block, so their copies must not grow with the ratings while a block fits a task
    assert als.block_count(3_600_000) == als.block_count(36_000_000) == 4
    assert als.block_count(216_000_000) == 6
    assert als.blocks_for(36_000_000, 8, cores=12) == 4
    assert als.blocks_for(36_000_000, 32, cores=12) == 12  # one wave, not 19 blocks in two
    assert als.blocks_for(1000, 32, cores=64) == 10


def test_a_grid_frees_what_a_fit_left(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(als, "freed", calls.append)
    rows = spark.createDataFrame([(u, i, float(1 + (u + i) % 5)) for u in range(12) for i in range(8)], "user_id int, item_id int, rating double")
    als.grid_report(rows, rows, [(2, 1, 0.1), (2, 2, 0.1)], parallelism=2)
    assert len(calls) == 2
