import math

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.operators import forest

NAMES = ["a", "b", "c"]


def table(spark, n=600):
    key = F.col("id")
    cols = [(key * 37 % 101).cast("double").alias("a"), (key * 53 % 17 / 3).alias("b"), (key % 4).cast("double").alias("c")]
    df = spark.range(n).select("id", *cols)
    return df.withColumn("label", F.expr("cast(int(a > 40) + int(c in (1, 3)) + int(b > 4) as int) % 2").cast("double"))


@pytest.mark.parametrize("categorical", [False, True])
def test_scores_equal_the_model(spark, categorical):
    df = table(spark)
    assembled = VectorAssembler(inputCols=NAMES, outputCol="raw").transform(df)
    assembled = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=5 if categorical else 2).fit(assembled).transform(assembled)
    model = RandomForestClassifier(numTrees=8, maxDepth=5, seed=7).fit(assembled)
    nodes = forest.forest_nodes(model)
    assert nodes.where("categories is not null").count() > 0 if categorical else nodes.where("categories is not null").count() == 0
    assert nodes.count() == model.totalNumNodes
    mine = {r.id: (r.prediction, r.probability) for r in forest.score_nodes(df, nodes, NAMES).collect()}
    theirs = {r.id: (r.prediction, r.p) for r in model.transform(assembled).select("id", "prediction", vector_to_array("probability").alias("p")).collect()}
    assert mine == theirs


def test_nulls_go_right_and_ties_to_the_smaller_class(spark):
    rows = [(0, 0, 0, 1.5, None, 1, 2, None), (0, 1, None, None, None, None, None, [0.75, 0.25]), (0, 2, None, None, None, None, None, [0.5, 0.5])]
    nodes = spark.createDataFrame(rows, forest.NODE_SCHEMA)
    df = spark.createDataFrame([(1, 1.5), (2, 1.6), (3, None), (4, math.nan)], "id long, a double")
    got = sorted((r.id, r.prediction, r.probability) for r in forest.score_nodes(df, nodes, ["a"]).collect())
    assert got == [(1, 0.0, [0.75, 0.25]), *[(i, 0.0, [0.5, 0.5]) for i in (2, 3, 4)]]


def test_scoring_shuffles_nothing(spark):
    from tessera.plans.inspect import physical_operators, uses_python
    from tessera.sources.testdata import forest as fixed

    df = spark.createDataFrame([(1, *[1.0] * 20)], "id long, " + ", ".join(f"f{i} double" for i in range(20)))
    got = forest.score_nodes(df, fixed(spark), [f"f{i}" for i in range(20)])
    assert "Exchange" not in physical_operators(got) and not uses_python(got)


def test_too_many_nodes_are_an_error(spark, monkeypatch):
    from tessera.sources.testdata import forest as fixed

    monkeypatch.setattr(forest, "MAX_NODES", 3)
    with pytest.raises(ValueError):
        forest.score_nodes(spark.range(1), fixed(spark), ["id"] * 20)
