from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import ratings as R

SCHEMA = "user_id long, item_id long, rating double"
DATA = [
    (1, 10, 4.0), (1, 11, 2.0), (1, 12, 3.0),
    (2, 10, 5.0), (2, 13, 5.0),  # all equal
    (3, 11, 1.5),  # one rating
    (4, 12, 2.0), (4, 12, 4.0),  # duplicate pair
]


def _r(spark):
    return spark.createDataFrame(DATA, SCHEMA)


def test_user_avg(spark):
    assert rows(R.user_avg(_r(spark))) == [(1, 3.0, 3), (2, 5.0, 2), (3, 1.5, 1), (4, 3.0, 2)]


def test_normalize_user_means_one(spark):
    n = R.normalize(_r(spark), "user")
    assert n.columns == ["user_id", "item_id", "rating"]
    for u, m, _ in rows(R.user_avg(n)):
        assert abs(m - 1.0) < 1e-9
    assert n.count() == len(DATA)  # duplicates kept


def test_normalize_max_and_none(spark):
    assert sorted(r.rating for r in R.normalize(_r(spark), "max").collect()) == sorted(x[2] / 5 for x in DATA)
    assert R.normalize(_r(spark), "none").count() == len(DATA)


def test_above_avg_inclusive(spark):
    got = rows(R.above_avg(_r(spark)))
    assert got == [(1, 10, 4.0), (1, 12, 3.0), (2, 10, 5.0), (2, 13, 5.0), (3, 11, 1.5), (4, 12, 4.0)]


def test_profile_good_and_new_user(spark):
    prof = spark.createDataFrame([(10, "t10", 5), (11, "t11", 0), (12, "t12", 2), (13, "t13", 3)],
                                 "item_id long, title string, rating int")
    assert [r.item_id for r in R.known(prof).collect()] == [10, 12, 13]
    assert sorted(r.item_id for r in R.profile_good(prof).collect()) == [10]  # mean 10/3, 3 < mean
    both = R.with_new_user(R.normalize(_r(spark), "user"), prof, -1)
    new = {r.item_id: r.rating for r in both.filter("user_id = -1").collect()}
    assert new == {10: 5 / (10 / 3), 12: 2 / (10 / 3), 13: 3 / (10 / 3)}
    assert both.count() == len(DATA) + 3


def test_empty_profile(spark):
    prof = spark.createDataFrame([(10, "t", 0)], "item_id long, title string, rating int")
    assert R.profile_good(prof).count() == 0


def test_popular_items_ties_by_id(spark):
    items = spark.createDataFrame([(10, "ten"), (12, "twelve")], "item_id long, title string")
    got = rows(R.popular_items(_r(spark), items, k=3))
    assert got == [(10, 2, "ten"), (11, 2, None), (12, 3, "twelve")]


def test_sample_items_reproducible_subset(spark):
    cands = spark.range(100).withColumnRenamed("id", "item_id")
    a = [r.item_id for r in R.sample_items(cands, 25, seed=3).collect()]
    b = [r.item_id for r in R.sample_items(cands.repartition(7), 25, seed=3).collect()]
    assert a == b and len(set(a)) == 25
    assert a != [r.item_id for r in R.sample_items(cands, 25, seed=4).collect()]


def test_hash_split_disjoint_cover_and_stable(spark):
    df = spark.range(20000).select(F.col("id").alias("user_id"), (F.col("id") % 97).alias("item_id"))
    train, test = R.hash_split(df, ["user_id", "item_id"], (0.8, 0.2), seed=5)
    a, b = {r.user_id for r in train.collect()}, {r.user_id for r in test.collect()}
    assert not a & b and len(a | b) == 20000
    assert 0.77 < len(a) / 20000 < 0.83
    train2, _ = R.hash_split(df.repartition(13), ["user_id", "item_id"], (0.8, 0.2), seed=5)
    assert {r.user_id for r in train2.collect()} == a


def test_exclude_seen(spark):
    ranked = spark.createDataFrame([(i, float(100 - i)) for i in range(30)], "item_id long, score double")
    seen = spark.createDataFrame([(0,), (2,), (29,)], "item_id long")
    got = [r.item_id for r in R.exclude_seen(ranked, seen, "score", 5).collect()]
    assert got == [1, 3, 4, 5, 6]


def test_random_split_parity(spark):
    df = spark.range(1000)
    a, b = R.random_split(df, (0.8, 0.2), seed=5)
    assert a.count() + b.count() == 1000 and not set(a.toPandas().id) & set(b.toPandas().id)


def test_param_label_column(spark):
    from tessera.functions.text import param_label
    from tessera.operators.als import param_label as label_str

    df = spark.createDataFrame([(8, 20, 0.01)], "r int, i int, l double")
    assert df.select(param_label("r", "i", "l")).first()[0] == "Rank8Iteration20Lambda0.01" == label_str(8, 20, 0.01)


def test_dedupe(spark):
    got = rows(R.dedupe(_r(spark)))
    assert (4, 12, 3.0) in got and len(got) == len(DATA) - 1
    assert rows(R.dedupe(_r(spark), "max")).count((4, 12, 4.0)) == 1
    assert R.dedupe(_r(spark), "keep").count() == len(DATA)


def test_hash_split_xxhash_variant(spark):
    df = spark.range(20000).select(F.col("id").alias("user_id"), (F.col("id") % 97).alias("item_id"))
    train, test = R.hash_split(df, ["user_id", "item_id"], (0.8, 0.2), seed=5, fn="xxhash64")
    a, b = {r.user_id for r in train.collect()}, {r.user_id for r in test.collect()}
    assert not a & b and len(a | b) == 20000 and 0.77 < len(a) / 20000 < 0.83


def test_small_weight_keeps_its_share(spark):
    df = spark.range(100_000).selectExpr("id as user_id", "id as item_id")
    big, small = R.hash_split(df, ["user_id"], (0.9996, 0.0004), seed=5)
    assert 10 < small.count() < 90 and big.count() + small.count() == 100_000
