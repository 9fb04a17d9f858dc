"""Partitioned sinks that may be run again: what is already there stays untouched.

``publish`` writes a table by the values of some columns, a folder each (Spark's dynamic partition overwrite), and keeps a manifest beside
the folders: rows and a digest per partition. A later run compares digests first and writes only what differs, so a
repeated run writes nothing, and one that was broken off goes on where the manifest ends. A partition is replaced as a whole
and recorded after it has been written: a loss in between costs a second write, never a half one.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Beside the partitions' folders; readers pass over names that start so.
MANIFEST = "_manifest"


class Published(NamedTuple):
    written: int
    unchanged: int


def _key(by: list[str]) -> F.Column:
    """A partition's values as text; null is a value of its own."""
    return F.to_json(F.struct(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0null")).alias(c) for c in by]))


def digests(df: DataFrame, by: list[str]) -> DataFrame:
    """``partition, n, digest``: the digest is a sum over the rows, so their order and files don't matter."""
    columns = sorted(c for c in df.columns if c not in by)
    text = [F.coalesce(F.to_json(F.struct(F.col(f"`{c}`").alias("v"))), F.lit("")) for c in columns]
    row = F.xxhash64(F.lit(",".join(columns)), *text).cast("decimal(38,0)")
    return df.groupBy(_key(by).alias("partition")).agg(F.count(F.lit(1)).alias("n"), F.sum(row).cast("string").alias("digest"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``partition, n, digest``: what the last run that recorded a partition has said of it."""
    try:
        runs = spark.read.parquet(f"{path}/{MANIFEST}")
    except AnalysisException:  # nothing has been published there
        return spark.createDataFrame([], "partition string, n long, digest string")
    last = runs.groupBy("partition").agg(F.max_by(F.struct("n", "digest"), "run").alias("last"))
    return last.select("partition", "last.n", "last.digest")


def publish(df: DataFrame, path: str, by: list[str], source: str = "parquet", **options: str) -> Published:
    """Write ``df`` below ``path`` by the columns ``by`` in the format ``source`` (parquet, csv, json, orc). Partitions that ``df``
    has no row of stay as they are. One run at a time."""
    spark = df.sparkSession
    before = manifest(spark, path).select("partition", F.col("digest").alias("old"), F.col("n").alias("old_n"))
    now = digests(df, by).checkpoint(eager=True)  # a row per partition
    changed = now.join(before, "partition", "left").where("old is null or old <> digest or old_n <> n").select("partition", "n", "digest").checkpoint(eager=True)
    todo, total = changed.count(), now.count()
    if todo:
        out = df.withColumn("__partition", _key(by)).join(changed.select(F.col("partition").alias("__partition")), "__partition", "left_semi").drop("__partition")
        run = int(manifest_runs(spark, path))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options).partitionBy(*by).format(source).save(path)
        changed.withColumn("run", F.lit(run + 1).cast("long")).write.mode("append").parquet(f"{path}/{MANIFEST}")
    return Published(todo, total - todo)


def manifest_runs(spark: SparkSession, path: str) -> int:
    """The number of the last run, 0 before the first."""
    try:
        return spark.read.parquet(f"{path}/{MANIFEST}").agg(F.max("run")).first()[0] or 0
    except AnalysisException:
        return 0
