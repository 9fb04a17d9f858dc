"""Evaluation metrics as aggregations (no rows gathered on the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.prefix import running_sum_below


def join_predictions(actual: DataFrame, predicted: DataFrame, keys=("user_id", "item_id"), pred: str = "prediction") -> DataFrame:
    """Inner join of actual rows with predictions on ``keys``: pairs without a prediction
    vanish and duplicate pairs multiply, as a plain equi-join does."""
    return actual.join(predicted.select(*keys, pred), list(keys))


def mse(df: DataFrame, label: str = "rating", pred: str = "prediction") -> DataFrame:
    """One row ``mse, n``: mean of ``(label − pred)²`` over the rows."""
    d = F.col(label) - F.col(pred)
    return df.agg(F.avg(d * d).alias("mse"), F.count(F.lit(1)).alias("n"))


def auc(df: DataFrame, label: str = "label", score: str = "score", buckets: int | None = None) -> DataFrame:
    """Exact area under the ROC curve, one row ``auc, n_pos, n_neg``.

    ``AUC = Σ_s pos(s) · (2·neg(<s) + neg(s)) / (2·P·N)``: ties count one half. Rows are first
    folded to one row per distinct score (partial aggregation, so heavy ties cost nothing);
    ``neg(<s)`` is a running sum computed range by range (see ``tessera.operators.prefix``),
    so no task ever holds all distinct scores. The products are summed as 38-digit decimals, so
    the counts may be as large as 64-bit numbers hold and the single final division is the only
    rounding. Rows without a label or a score are left out.
    """
    positive = F.col(label) > 0.5
    g = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(score).agg(
        F.sum(F.when(positive, 1).otherwise(0)).alias("_p"),
        F.sum(F.when(positive, 0).otherwise(1)).alias("_q"),
    )
    return auc_of_counts(running_sum_below(g, score, "_q", "_below", buckets))


def auc_of_counts(counts: DataFrame) -> DataFrame:
    """``auc, n_pos, n_neg`` from one row per score: ``_p`` positives, ``_q`` negatives, ``_below``
    negatives with a smaller score."""
    wide = "decimal(19,0)"  # a product of two has 38 digits
    twice = F.col("_below").cast(wide) * 2 + F.col("_q").cast(wide)
    t = counts.agg(
        F.sum((F.col("_p").cast(wide) * twice.cast(wide)).cast("decimal(38,0)")).alias("_num"),
        F.sum("_p").alias("n_pos"),
        F.sum("_q").alias("n_neg"),
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg").cast("double") * 2
    return t.select(F.try_divide(F.col("_num").cast("double"), pairs).alias("auc"), "n_pos", "n_neg")


def auc_evaluator(df: DataFrame, label: str = "label", raw: str = "rawPrediction") -> float:
    """Spark's ``BinaryClassificationEvaluator`` (areaUnderROC) with exact (unbinned) curves."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC", numBins=0)
    return ev.evaluate(df)
