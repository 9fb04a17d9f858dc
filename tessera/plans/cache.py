"""Cache a table for a block of work that reads it several times, and always release it."""

from __future__ import annotations

import contextlib
import gc
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


@contextlib.contextmanager
def persisted(*dfs: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[tuple[DataFrame, ...]]:
    """``with persisted(a, b) as (a, b): ...`` — cached while the block runs, unpersisted after.

    A lost executor only costs a recomputation from lineage; nothing is checkpointed.
    """
    held = tuple(df.persist(level) for df in dfs)
    try:
        yield held
    finally:
        for df in held:
            df.unpersist()


@contextlib.contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Drop, at the end of the block, every RDD that was cached inside it (model fits keep theirs)."""
    jsc = spark.sparkContext._jsc
    before = set(jsc.getPersistentRDDs().keySet())
    try:
        yield
    finally:
        held = jsc.getPersistentRDDs()
        for number in set(held.keySet()) - before:
            held[number].unpersist(False)


def freed(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of tables that nothing refers to any more. It does so after a collection of the
    driver's garbage, which a driver with little to do may not need for hours while the files of each fit stay on disk."""
    gc.collect()  # Python's references to the tables first
    spark.sparkContext._jvm.System.gc()
