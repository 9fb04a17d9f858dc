import os

from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from conftest import rows
from tessera.functions.codes import shift_codes
from tessera.operators import classify
from tessera.operators import ratings as R
from tessera.sources import readers, schemas
from tessera.sources import testdata as td

SMALL_GRID = {"impurity": ["gini"], "maxBins": [16], "maxDepth": [2, 3]}


def test_read_credit_shifts_codes(spark, tmp_out):
    line = ",".join(str(i + 1) for i in range(21))
    with open(f"{tmp_out}/c.csv", "w") as f:
        f.write(line + "\n1,x" + ",1" * 19 + "\n")
    df = readers.read_credit(spark, f"{tmp_out}/c.csv")
    first = df.first().asDict()
    for i, c in enumerate(schemas.CREDIT_COLUMNS):
        assert first[c] == (i + 1) - (1 if c in schemas.CREDIT_SHIFTED else 0)
    assert df.filter(F.col("balance").isNull()).count() == 1  # "x" → NULL, row kept


def test_label_index_matches_string_indexer(spark, sf_dir):
    df = shift_codes(td.credit_raw(spark, sf_dir), schemas.CREDIT_SHIFTED)
    mine = {r.creditability: r.label for r in classify.label_index(df).collect()}
    model = StringIndexer(inputCol="creditability", outputCol="l").fit(df)
    assert mine == {float(v): float(i) for i, v in enumerate(model.labels)}


def test_label_index_tie_is_alphabetical(spark):
    df = spark.createDataFrame([(1.0,), (0.0,)], "creditability double")
    assert rows(classify.label_index(df), "creditability", "label") == [(0.0, 0.0), (1.0, 1.0)]


def test_fit_save_load_score(spark, sf_dir, tmp_out):
    df = shift_codes(td.credit_raw(spark, sf_dir), schemas.CREDIT_SHIFTED)
    train, test = R.hash_split(df, ["id"], (0.75, 0.25), seed=classify.SEED)
    model = classify.build(df, grid=SMALL_GRID, parallelism=2).fit(train)
    best = classify.best_params(model, train, test).first()
    assert best.impurity == "gini" and best.maxDepth in (2, 3)
    assert 0.0 <= best.test_auc <= 1.0 and 0.0 <= best.train_auc <= 1.0
    path = classify.save(model, f"{tmp_out}/model")
    assert os.path.isdir(path)
    a = rows(classify.score(model, test), "id", "prediction")
    b = rows(classify.score(classify.load(path), test), "id", "prediction")
    assert a == b and len(a) == test.count()


def test_grids():
    from pyspark.ml.classification import RandomForestClassifier

    rf = RandomForestClassifier()
    assert len(classify.param_grid(rf)) == 18
    assert len(classify.param_grid(rf, classify.EXTENDED_GRID)) == 14400


def test_cross_validation_variant(spark, sf_dir):
    df = shift_codes(td.credit_raw(spark, sf_dir), schemas.CREDIT_SHIFTED)
    model = classify.build(df, grid={"maxDepth": [2]}, parallelism=2, folds=2).fit(df)
    from pyspark.ml.tuning import CrossValidatorModel

    assert isinstance(model.stages[-1], CrossValidatorModel)
    assert classify.score(model, df).count() == df.count()
