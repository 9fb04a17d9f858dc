"""Credit-risk classification with ``pyspark.ml``: feature assembly, label indexing, a random
forest tuned by train/validation split, AUC, and a saved pipeline for batch scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.schemas import CREDIT_LABEL

SEED = 4321

# --- fixed values: the reference's tuning grids --------------------------------------------
MAIN_GRID = {
    "featureSubsetStrategy": ["auto"],
    "impurity": ["entropy", "gini"],
    "maxBins": [24, 28, 32],
    "maxDepth": [3, 5, 7],
}
EXTENDED_GRID = {
    "featureSubsetStrategy": ["auto", "all", "onethird", "sqrt", "log2"],
    "impurity": ["entropy", "gini"],
    "maxBins": [24, 28, 32, 12, 16, 20, 36, 40],
    "maxDepth": [3, 5, 7, 2, 4, 6, 8, 9, 10],
    "numTrees": [20, 24, 28, 32],
    "subsamplingRate": [0.1, 0.25, 0.5, 0.75, 1.0],
}
# --- end of fixed values -------------------------------------------------------------------


def feature_columns(df: DataFrame, label: str = CREDIT_LABEL, exclude: Sequence[str] = ("id",)) -> list[str]:
    """All columns except the label (and identifiers)."""
    return [c for c in df.columns if c != label and c not in exclude]


def assembler(features: Sequence[str], out: str = "features", invalid: str = "error") -> VectorAssembler:
    """``invalid``: what a NULL does: ``error`` (default), ``skip`` the row, or ``keep`` it as NaN."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid=invalid)


def label_indexer(df: DataFrame, label: str = CREDIT_LABEL, out: str = "label") -> StringIndexerModel:
    """Label index fitted on the table given (most frequent value → 0.0, ties alphabetical)."""
    return StringIndexer(inputCol=label, outputCol=out, stringOrderType="frequencyDesc").fit(df)


def label_index(df: DataFrame, label: str = CREDIT_LABEL) -> DataFrame:
    """``{label}, n, label``: the index ``StringIndexer`` assigns, as a table.

    Values are counted by a grouped aggregate; the ranking window then runs over one row per
    distinct label value, a table bounded by the number of classes.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(F.desc("n"), F.col(label).cast("string"))
    return counts.withColumn("label", (F.row_number().over(w) - 1).cast("double"))


def forest(seed: int = SEED, features: str = "features", label: str = "label") -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=features, labelCol=label, seed=seed)


def param_grid(rf: RandomForestClassifier, grid: dict | None = None) -> list:
    b = ParamGridBuilder()
    for name, values in (grid or MAIN_GRID).items():
        b = b.addGrid(rf.getParam(name), list(values))
    return b.build()


def evaluator(label: str = "label") -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")


def tuner(rf, grid, label: str = "label", ratio: float = 0.75, seed: int = SEED, parallelism: int = 4, folds: int | None = None):
    """Train/validation split tuning (or ``folds``-fold cross-validation)."""
    if folds:
        return CrossValidator(
            estimator=rf, estimatorParamMaps=grid, evaluator=evaluator(label), numFolds=folds, seed=seed,
            parallelism=parallelism,
        )
    return TrainValidationSplit(
        estimator=rf, estimatorParamMaps=grid, evaluator=evaluator(label), trainRatio=ratio, seed=seed,
        parallelism=parallelism,
    )


def build(df_all: DataFrame, label: str = CREDIT_LABEL, grid: dict | None = None, seed: int = SEED,
          parallelism: int = 4, folds: int | None = None, index_on: DataFrame | None = None) -> Pipeline:
    """Assembler → label index → tuned forest.

    The label index is fitted on ``df_all`` (the whole table, so its order is stable across
    splits) unless ``index_on`` names another table, e.g. the training split only.
    """
    rf = forest(seed)
    return Pipeline(
        stages=[
            assembler(feature_columns(df_all, label)),
            label_indexer(index_on if index_on is not None else df_all, label),
            tuner(rf, param_grid(rf, grid), seed=seed, parallelism=parallelism, folds=folds),
        ]
    )


def best_params(model: PipelineModel, train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: the chosen impurity, bins and depth, and the AUC on train and test."""
    best = model.stages[-1].bestModel
    ev = evaluator()
    row = (
        best.getImpurity(),
        int(best.getMaxBins()),
        int(best.getMaxDepth()),
        float(ev.evaluate(model.transform(train))),
        float(ev.evaluate(model.transform(test))),
    )
    return train.sparkSession.createDataFrame(
        [row], "impurity string, maxBins int, maxDepth int, train_auc double, test_auc double"
    )


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
    """``*keep, label, prediction, p1``: scored rows with the probability of class 1."""
    out = model.transform(df)
    labels = ["label"] if "label" in out.columns else []
    return out.select(*keep, *labels, "prediction", vector_to_array("probability")[1].alias("p1"))


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
