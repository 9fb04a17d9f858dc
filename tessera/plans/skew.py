"""Skew-safe joins of a large table with a per-key table (one or few rows per key).

AQE splits skewed partitions only when both join inputs are plain shuffle stages; a per-key
table produced by an aggregation in the same plan (per-user means, per-item predictions)
does not qualify, so a key holding a third of the rows would land in one task. Here such
keys are salted explicitly:

* a key is hot when it holds more than ``HOT_SHARE`` times the mean rows of a partition; there are fewer
  than ``parts / HOT_SHARE`` such keys, so the list is bounded and is broadcast;
* a hot key of ``n`` rows gets ``ceil(n / mean)`` salts, so the salts of all hot keys together, and with them the
  copies of the per-key rows, number at most twice ``parts``;
* a row's salt hashes the row and the number of its partition, so equal rows of several partitions spread too, and a
  retried task deals its rows as before; rows of other keys get salt 0;
* without a hot key the plain join runs.

Results are identical to the plain join; only the distribution of work changes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_SHARE = 2


def target_parts(df: DataFrame, parts: int | None = None) -> int:
    if parts:
        return int(parts)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def hot_keys(counts: DataFrame, key: str, count_col: str, parts: int) -> list[tuple]:
    """(key, salts) of the keys with more than ``HOT_SHARE`` times the mean rows of a partition.

    A map-side top-k of ``parts / HOT_SHARE`` rows holds them all. Null keys join nothing and are left out."""
    total = counts.agg(F.sum(count_col)).first()[0] or 0
    mean = max(1.0, total / parts)
    top = counts.filter(F.col(key).isNotNull() & (F.col(count_col) > HOT_SHARE * mean))
    rows = top.orderBy(F.desc(count_col), F.asc(key)).limit(max(1, parts // HOT_SHARE)).select(key, count_col).collect()
    return [(r[0], math.ceil(r[1] / mean)) for r in rows]


def salted_join(big: DataFrame, small: DataFrame, key: str, hot: list[tuple], how: str = "inner") -> DataFrame:
    """``big`` joined with ``small`` on ``key``, each hot key spread over its salts.

    ``hot`` comes from ``hot_keys``; ``how`` is ``inner`` or ``left`` (rows of ``big`` kept)."""
    if not hot:
        return big.join(small, key, how)
    schema = f"`{key}` {small.schema[key].dataType.simpleString()}, _salts int"
    flag = F.broadcast(big.sparkSession.createDataFrame(hot, schema))
    plain = [f.name for f in big.schema.fields if not isinstance(f.dataType, T.MapType)]  # maps can't be hashed
    place = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in plain])
    b = big.withColumn("_place", place).join(flag, key, "left")
    b = b.withColumn("_salt", F.coalesce(F.pmod(F.col("_place"), F.col("_salts")), F.lit(0)).cast("int"))
    s = small.join(flag, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    )
    return b.drop("_place", "_salts").join(s.drop("_salts"), [key, "_salt"], how).drop("_salt")


def join_per_key(
    big: DataFrame,
    small: DataFrame,
    key: str,
    counts: DataFrame | None = None,
    count_col: str = "n",
    how: str = "inner",
    parts: int | None = None,
) -> DataFrame:
    """Skew-safe ``big ⋈ small`` on ``key``.

    ``counts`` gives rows of ``big`` per key (``key, count_col``); when absent it is computed
    by a grouped count (partially aggregated map-side).
    """
    if counts is None:
        counts = big.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
    return salted_join(big, small, key, hot_keys(counts, key, count_col, target_parts(big, parts)), how)
