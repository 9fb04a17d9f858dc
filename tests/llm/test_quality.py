import zlib

import numpy as np

from helpers import awkward, documents, frame
from tessera.llm import quality as Q


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def slow_margin(model, row):
    total = model.base
    for f, c, leaf in zip(model.feature, model.cut, model.leaf, strict=True):
        node = 0
        for _ in range(model.depth):
            node = 2 * node + (2 if row[f[node]] > c[node] else 1)
        total += leaf[node - len(f)]
    return total


def test_flat_trees_follow_the_nodes():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    model = Q.boost(x, y, trees=30, depth=3)
    fast = model.margin(x)
    assert np.allclose(fast, [slow_margin(model, r) for r in x])
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def test_held_out_accuracy(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.01"
    got = E.queries()["op10_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert all(got["held_out"] == [held(d) for d in got["doc_id"]])
    assert ((got["score"] >= 0.3) == (got["predicted"] == 1)).all() and got["score"].between(0, 1).all()
    out = got[got["held_out"]]
    assert (out["predicted"] == out["quality"]).mean() > 0.95


def test_awkward_rows_and_few_labels(spark):
    docs = frame(spark, extra="score")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, quality int")
    got = Q.score(docs, Q.fit(docs, labels)).collect()
    assert len(got) == len(awkward()) and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(s) == 1 for s in by.values())
    none = Q.fit(docs, labels.limit(0))
    assert {r.score for r in Q.score(docs, none).collect()} == {0.5}
    one = Q.fit(docs, labels.filter("quality = 1"))
    assert all(r.predicted == 1 for r in Q.score(docs, one).collect())


def test_accepted_keeps_the_columns(spark):
    docs = documents(spark)
    assert Q.accepted(docs, Q.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))).collect() == docs.collect()


def test_sample_is_a_bound(spark):
    docs = documents(spark, [(i, f"text {i}") for i in range(50)])
    labels = spark.range(50).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    assert Q.fit(docs, labels, sample=10).base is not None
    assert Q.fit(docs.limit(0), labels).base == 0.0
