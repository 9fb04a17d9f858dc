"""Saving and loading fitted models by path (shared storage, not the driver's disk)."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

M = TypeVar("M")


def saved(spark: SparkSession, path: str) -> bool:
    """Whether a model is saved at ``path``. A store that can't be asked raises its error."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/metadata")
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def fit_or_load(path: str, fit: Callable[[], M], load: Callable[[str], M], refit: bool = False) -> M:
    """Load the model saved at ``path``; fit and save it when absent or when ``refit`` is set.

    An error in loading is raised: it never leads to fitting afresh over a saved model."""
    spark = SparkSession.active()  # also in a thread of a pool
    if not refit and saved(spark, path):
        return load(path)
    model = fit()
    model.write().overwrite().save(path)
    return model


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path
