import math

from conftest import rows
from tessera.operators import knn
from tessera.operators import ratings as R


def _vec(spark, data):
    return spark.createDataFrame(data, "user_id long, genre string, n long")


def _pvec(spark, data):
    return spark.createDataFrame(data, "genre string, n long")


def test_item_genres(spark):
    items = spark.createDataFrame([(1, "A|B|"), (2, "(no genres listed)"), (3, "C")], "item_id long, genres string")
    assert rows(knn.item_genres(items)) == [(1, "A"), (1, "B"), (2, "(no genres listed)"), (3, "C")]


def test_cosine_properties(spark):
    vec = _vec(spark, [(1, "a", 2), (1, "b", 4), (2, "a", 1), (2, "b", 2), (3, "c", 7), (4, "a", 3)])
    pv = _pvec(spark, [("a", 1), ("b", 2)])
    sims = dict(rows(knn.user_cosine(vec, pv)))
    assert abs(sims[1] - 1.0) < 1e-12 and abs(sims[2] - 1.0) < 1e-12  # multiples of the profile
    assert sims[3] == 0.0  # no shared genre
    assert abs(sims[4] - 1 / math.sqrt(5)) < 1e-12
    assert all(0.0 <= s <= 1.0 for s in sims.values())


def test_cosine_symmetric(spark):
    u = [("a", 3), ("b", 1), ("c", 2)]
    v = [("a", 1), ("c", 5)]
    s1 = rows(knn.user_cosine(_vec(spark, [(1, g, n) for g, n in u]), _pvec(spark, v)))[0][1]
    s2 = rows(knn.user_cosine(_vec(spark, [(1, g, n) for g, n in v]), _pvec(spark, u)))[0][1]
    assert abs(s1 - s2) < 1e-12


def test_empty_profile_gives_no_neighbours(spark):
    vec = _vec(spark, [(1, "a", 2)])
    assert knn.user_cosine(vec, _pvec(spark, [])).count() == 0


def test_knn_flow(spark):
    ratings = spark.createDataFrame(
        [(1, 100, 5.0), (1, 101, 1.0), (2, 100, 3.0), (2, 102, 4.0), (3, 103, 5.0), (-1, 100, 5.0)],
        "user_id long, item_id long, rating double",
    )
    sims = spark.createDataFrame([(1, 0.9), (2, 0.8), (3, 0.1), (-1, 1.0)], "user_id long, sim double")
    nn = knn.knn_users(sims, k=2, exclude=-1)
    assert [r.user_id for r in nn.collect()] == [1, 2]
    prof = spark.createDataFrame([(100, "t", 4), (101, "u", 0)], "item_id long, title string, rating int")
    items = spark.createDataFrame([(101, "x"), (102, "y")], "item_id long, title string")
    rec = knn.knn_recommend(ratings, nn, prof, items, n=5)
    # 100 was rated by the profile; 101 was rated 0 (unknown) so it stays a candidate
    assert rows(rec, "item_id", "avg_rating", "title") == [(101, 1.0, "x"), (102, 4.0, "y")]
    good = knn.knn_recommend(ratings, nn, prof, None, n=5, only_good=True)
    assert rows(good, "item_id") == [(102,)]


def test_user_vectors_from_liked(spark):
    ratings = spark.createDataFrame([(1, 10, 5.0), (1, 11, 1.0), (1, 12, 4.0)], "user_id long, item_id long, rating double")
    items = spark.createDataFrame([(10, "A|B"), (11, "A"), (12, "B")], "item_id long, genres string")
    v = knn.user_vectors(R.above_avg(ratings), knn.item_genres(items))
    assert rows(v) == [(1, "A", 1), (1, "B", 2)]


def test_vector_map(spark):
    vec = _vec(spark, [(1, "b", 2), (1, "a", 1), (2, "c", 3)])
    got = {r.user_id: r.vector for r in knn.vector_map(vec).collect()}
    assert got == {1: {"a": 1, "b": 2}, 2: {"c": 3}}
