"""Running sums and dense ranks over a globally ordered column, without a single-task window.

A window ordered over a whole table (no ``partitionBy``) runs in one task. Instead the values
are cut into ``buckets`` contiguous ranges at approximate quantiles (``approxQuantile``: one
aggregation pass, ``buckets - 1`` numbers returned);
each range is ranked by a window partitioned by range, and the per-range totals — one number
per range, ``buckets`` at most — give the offsets, applied as a literal array. Results are
exact; only the balance between ranges is approximate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir


def default_buckets(df: DataFrame) -> int:
    """As many ranges as a shuffle has partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _materialize(df: DataFrame) -> DataFrame:
    """Write the (already reduced) input once to the shared checkpoint folder: the quantile
    cuts, the per-range totals and the ranking all read it, instead of recomputing the
    aggregation behind it three times."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def range_bucket(df: DataFrame, col: str, buckets: int | None = None, out: str = "_bucket") -> tuple[DataFrame, int]:
    """Add ``out``: the index of the quantile range ``col`` falls in (monotone in ``col``).

    Returns the frame and the number of ranges.
    """
    buckets = buckets or default_buckets(df)
    probs = [i / buckets for i in range(1, buckets)]
    # buckets-1 cut points come back to the driver, like a range partitioner's sample.
    cuts = sorted(set(df.approxQuantile(col, probs, 1.0 / (4 * buckets)))) if probs else []
    # With no cut the single bucket is still derived from the column (a literal bucket key
    # would be constant-folded).
    bounds = [float(c) for c in cuts] or [float("inf")]
    arr = F.array(*[F.lit(b) for b in bounds])
    return df.withColumn(out, F.size(F.filter(arr, lambda b: b <= F.col(col).cast("double")))), len(bounds) + 1


def _offsets(df: DataFrame, bucket: str, value, n: int):
    """Column: the sum of ``value`` over all buckets before the row's bucket.

    The per-bucket totals are one number per bucket (at most ``n``, a parameter), so they are
    fetched and applied as a literal array; no window over the whole table, no join.
    """
    totals = {r[0]: r[1] or 0 for r in df.groupBy(bucket).agg(F.sum(value)).collect()}
    offs, acc = [], 0
    for b in range(n):
        offs.append(acc)
        acc += totals.get(b, 0)
    return F.element_at(F.array(*[F.lit(o) for o in offs]), F.col(bucket) + 1)


def running_sum_below(
    df: DataFrame, order: str, value: str, out: str, buckets: int | None = None
) -> DataFrame:
    """Add ``out`` = Σ ``value`` over rows with a smaller ``order`` (rows must have distinct
    ``order`` values, e.g. after a ``groupBy(order)``)."""
    df = _materialize(df)
    b, n = range_bucket(df, order, buckets)
    w = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = b.withColumn("_in", F.coalesce(F.sum(value).over(w), F.lit(0)))
    return local.select(*df.columns, (_offsets(b, "_bucket", F.col(value), n) + F.col("_in")).alias(out))


def dense_index(df: DataFrame, col: str, out: str = "idx", buckets: int | None = None) -> DataFrame:
    """``col, out``: each distinct value of ``col`` numbered 0..n-1 in ascending order."""
    d, n = range_bucket(_materialize(df.select(col).distinct().filter(F.col(col).isNotNull())), col, buckets)
    w = Window.partitionBy("_bucket").orderBy(col)
    local = d.withColumn("_r", F.row_number().over(w) - 1)
    return local.select(col, (_offsets(d, "_bucket", F.lit(1), n) + F.col("_r")).alias(out))
