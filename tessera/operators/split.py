"""Splits whose sides have exactly the sizes asked for.

A hash split gives each side about its share. Here the k smallest keys make the first side, for an exact k: the k-th key is
found by radix selection, one histogram of 16 bits at a time (a grouped aggregate of at most 65,536 rows), so nothing is
sorted and no task holds more than it reads. Rows with equal keys are told apart by a digest of the whole row, then (equal
rows, of which any may be taken) by a written row number.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import shared_path

DIGIT = 16


def key48(seed: int, *cols: Column) -> Column:
    """The first 48 bits of ``md5("seed:col:col...")`` as a whole number (null is an empty text)."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def smallest(df: DataFrame, key: str, k: int, bits: int = 48) -> tuple[int, int, int]:
    """(v, below, equal): the k-th smallest of the whole numbers ``key`` below 2^bits is v; so many are smaller and so
    many equal. 1 <= k <= rows."""
    value, below = 0, 0
    for shift in range(bits - DIGIT, -1, -DIGIT):
        here = df.where(F.shiftright(F.col(key), shift + DIGIT) == F.lit(value)) if shift < bits - DIGIT else df
        digit = F.shiftright(F.col(key), shift).bitwiseAND(F.lit((1 << DIGIT) - 1))
        for d, n in sorted(tuple(r) for r in here.groupBy(digit.alias("d")).count().collect()):  # at most 2^16 rows
            if below + n >= k:
                value = value << DIGIT | d
                equal = n
                break
            below += n
        else:
            raise ValueError(f"there are fewer than {k} rows")
    return value, below, equal


def exact_split(df: DataFrame, keys: Sequence[str], weights: Sequence[float] = (0.8, 0.2), seed: int = 5, out: str = "split") -> DataFrame:
    """``df`` with ``out``: the side of each row. Side i ends at row round(n * w(0..i) / w) of the order by a hash of ``keys``
    and the seed, then by one of all columns, so sizes are exact, and sides depend on nothing but the rows. A key's rows stay
    together except where a side ends among them."""
    spark = df.sparkSession
    columns = [F.col(f"`{c}`") for c in df.columns]
    path = shared_path(spark, "splits", uuid.uuid4().hex)
    keyed = df.withColumn("__k0", key48(seed, *[F.col(f"`{c}`") for c in keys])).withColumn("__k1", key48(seed, *columns))
    keyed.withColumn("__k2", F.monotonically_increasing_id()).write.parquet(path)  # numbers that don't change any more
    rows = spark.read.parquet(path)
    total, size, at = float(sum(weights)), rows.count(), 0.0
    side = F.lit(0)
    for weight in weights[:-1]:
        at += weight
        side = side + F.when(before(rows, round(size * at / total)), 0).otherwise(1)
    return rows.select(*columns, side.cast("int").alias(out))


def before(rows: DataFrame, k: int) -> Column:
    """True for the ``k`` smallest rows by (__k0, __k1, __k2)."""
    taken, ties = F.lit(False), F.lit(True)
    for key, bits in (("__k0", 48), ("__k1", 48), ("__k2", 64)):
        if k <= 0:
            return taken
        value, below, equal = smallest(rows, key, k, bits)
        taken = taken | (ties & (F.col(key) < value))
        ties = ties & (F.col(key) == value)
        if below + equal == k:
            return taken | ties
        rows, k = rows.where(F.col(key) == value), k - below
    return taken | ties
