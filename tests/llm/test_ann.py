import numpy as np
from pyspark.sql import functions as F

from tessera.llm import ann


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute(ids, x, query, k):
    s = ann.cosine(np.broadcast_to(x[ids.index(query)], x.shape).copy(), x)
    order = [i for i in np.lexsort((ids, -s)) if ids[i] != query][:k]
    return [(ids[i], s[i]) for i in order]


def test_recall_and_scores(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 24)).astype(np.float32)
    rows = [(i, [float(v) for v in x[i]], 0) for i in range(len(x))]
    got = ann.neighbours(table(spark, rows), F.col("id") % 50 == 0).collect()
    ids, hit, total = list(range(len(x))), 0, 0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(by) == list(range(0, 2000, 50))
    for q, found in by.items():
        want = dict(brute(ids, x.astype(float), q, 5))
        found.sort()
        assert [f[0] for f in found] == [1, 2, 3, 4, 5]
        assert [f[2] for f in found] == sorted((f[2] for f in found), reverse=True)
        hit += sum(f[1] in want for f in found)
        total += 5
        for _, v, s in found:
            assert want.get(v, s) == s
    assert hit / total >= 0.9


def test_copies_ties_and_unusable_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(i, v, 0) for i in range(0, 60)] + [(0, v, 0)]
    rows += [(100, None, 0), (150, [0.0, 0.0, 0.0], 0), (200, [1.0, None, 2.0], 0), (250, [float("nan"), 1.0, 1.0], 0)]
    rows += [(300, [float("inf"), 1.0, 1.0], 0), (350, [1.0, 2.0], 0), (None, v, 0)]
    got = ann.neighbours(table(spark, rows), F.col("id") % 50 == 0).collect()
    # the two rows of id 0 are queries of their own and find each other; 350 is alone with its length
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == sorted(
        2 * [(0, i, v) for i, v in enumerate((0, 1, 2, 3, 4), 1)] + [(50, i, v) for i, v in enumerate((0, 0, 1, 2, 3), 1)]
    )


def test_each_vector_length_is_searched_by_itself(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=2 + i % 3).tolist(), 0) for i in range(300)] + [(350, [1.0] * 7, 0), (400, [1.0] * 9, 0), (401, [1.0] * 9, 0)]
    got = {}
    for r in ann.neighbours(table(spark, rows), F.col("id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = 0
    for q in range(0, 300, 50):
        own = [r for r in rows if len(r[1]) == 2 + q % 3]
        want = brute([r[0] for r in own], np.array([r[1] for r in own], np.float32).astype(float), q, 5)
        assert len(got[q]) == 5
        hit += len({v for v, _ in want} & {v for _, v, _ in got[q]})
    assert hit >= 27 and 350 not in got
    assert [(v, round(s, 12)) for _, v, s in got[400]] == [(401, 1.0)]


def test_segments_and_clashing_columns_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    df = table(spark, [(i, rng.normal(size=6).tolist(), 0) for i in range(400)])
    plain = sorted(ann.neighbours(df, F.col("id") % 50 == 0).collect())
    monkeypatch.setattr(ann, "SEGMENT", 3)
    clashing = df.selectExpr("*", "1 as id", "2 as v", "3 as row", "4 as query", "5 as rank", "6 as score")
    assert sorted(ann.neighbours(clashing, F.col("id") % 50 == 0).collect()) == plain


def test_few_candidates_and_empty_table(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [-1.0, 0.0], 0)]
    got = ann.neighbours(table(spark, rows), F.col("id") % 50 == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 0.0), (2, -1.0)]
    assert ann.neighbours(table(spark, []), F.col("id") % 50 == 0).count() == 0


def test_every_code_within_the_radius_is_retrieved():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 256, (3000, 4), dtype=np.uint8)
    index = ann.BlockIndex(codes)
    for radius in (0, 1, 3, 5, 9, 14, 32):
        for code in codes[:20]:
            want = np.flatnonzero(np.bitwise_count(codes ^ code).sum(1) <= radius)
            assert np.array_equal(index.within(code, radius), want)


def test_query(spark, sf_dir):
    import __spark_entry__ as E

    got = E.queries()["op4_nearest"](spark, sf_dir).toPandas()
    table_ = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas().sort_values("vec_id")
    ids, x = table_["vec_id"].tolist(), np.array(table_["embedding"].tolist(), float)
    hit = sum(len({v for v, _ in brute(ids, x, q, 5)} & set(part["vec_id"])) for q, part in got.groupby("query_id"))
    assert hit / len(got) >= 0.9
