import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.operators import neighbours as N


def brute(vectors, is_profile, k):
    users = {}
    for u, g, n in vectors:
        users.setdefault(u, {})[g] = n
    norm = {u: np.sqrt(float(sum(n * n for n in v.values()))) for u, v in users.items()}
    out = []
    for p in filter(is_profile, users):
        sims = [(-float(sum(n * users[p].get(g, 0) for g, n in v.items())) / (norm[u] * norm[p]), u) for u, v in users.items() if u != p]
        out += [(p, i, u, -s) for i, (s, u) in enumerate(sorted(sims)[:k], 1)]
    return sorted(out)


def vectors(n, genres=30, seed=1):
    rnd = random.Random(seed)
    out = []
    for u in range(n):
        own = rnd.randrange(genres)  # most of a user's items are of one genre
        counts = {own: 30 + rnd.randrange(20)} | {rnd.randrange(genres): 1 + rnd.randrange(3) for _ in range(2)}
        out += [(u, f"g{g}", c) for g, c in counts.items()]
    return out + [(u, g, c) for u, g, c in out if u < 3 for u in (n + u,)]  # users that are equal


def rows_of(data):
    users = {}
    for u, g, n in data:
        users.setdefault(u, []).append((int(g[1:]), n))
    top = sorted(users, key=lambda u: max((n, g) for g, n in users[u])[1])
    cols = [pa.array(top), pa.array([[g for g, _ in sorted(users[u])] for u in top]), pa.array([[n for _, n in sorted(users[u])] for u in top])]
    return N.Users.of(pa.RecordBatch.from_arrays([*cols, pa.array([sum(n * n for _, n in users[u]) for u in top])], names=["user", "genre", "n", "nn"]))


def test_nearest_users_equal_brute_force(spark, monkeypatch):
    data = vectors(300)
    df = spark.createDataFrame(data, "user_id long, genre string, n long")
    for segment in (1024, 7):
        monkeypatch.setattr(N, "SEGMENT", segment)
        got = N.nearest_users(df, F.col("user") % 10 == 0, k=5)
        assert sorted(map(tuple, got.collect())) == brute(data, lambda u: u % 10 == 0, 5)


def test_few_users_and_no_profiles(spark):
    df = spark.createDataFrame([(0, "a", 2), (1, "b", 1), (2, "a", 1)], "user_id long, genre string, n long")
    got = N.nearest_users(df, F.col("user") == 0, k=5).orderBy("rank").collect()
    assert [(r.rank, r.user_id, r.sim) for r in got] == [(1, 2, 1.0), (2, 1, 0.0)]
    assert N.nearest_users(df, F.col("user") == 9).count() == 0
    assert N.nearest_users(df.limit(0), F.col("user") == 0).count() == 0


def test_blocks_out_of_reach_are_skipped():
    data = vectors(4000, seed=2)
    users = rows_of(data)
    found = N.Nearest(rows_of([r for r in data if r[0] % 100 == 0]), 5)
    for lo in range(0, len(users.id), 128):
        found.meet(users.cut(lo, min(lo + 128, len(users.id))))
    assert found.met < 0.7 * found.asked
    got = sorted((int(p), int(u), float(s)) for p, us, ss in zip(found.profiles.id, found.user, found.score) for u, s in zip(us, ss))
    assert got == sorted((p, u, s) for p, _, u, s in brute(data, lambda u: u % 100 == 0, 5))


def test_many_genres_are_multiplied_in_parts(monkeypatch):
    data = vectors(60)
    users = rows_of(data)
    who, genres = np.arange(len(users.id)), np.unique(users.genre)
    whole = N.products(users, who, users, genres)
    monkeypatch.setattr(N, "LISTS", 4)
    assert (N.products(users, who, users, genres) == whole).all()
    assert (np.diag(whole) == users.norm**2).all() or np.allclose(np.diag(whole), users.norm**2)


def test_pairs_are_never_a_table(spark):
    from tessera.plans.inspect import physical_operators

    df = spark.createDataFrame(vectors(50), "user_id long, genre string, n long")
    plan = physical_operators(N.nearest_users(df, F.col("user") % 10 == 0))
    assert "Join" not in plan
