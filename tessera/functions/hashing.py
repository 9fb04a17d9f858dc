"""Deterministic, partition-independent keys for sampling and splitting.

``randomSplit`` and ``rand`` depend on how rows are partitioned, so a re-run on a cluster with
another layout (or a retried task) may move rows between sides. A hash of the row key does not.
The key is ``md5("seed:k1:k2...")``; its first 8 hex digits give an integer in [0, 2^32).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import as_col


def hash_key(seed: int, *cols, fn: str = "md5") -> Column:
    """Integer in [0, 2^32) from a hash of the seed and the key columns.

    ``md5`` (default) is reproducible in other engines (the oracle uses it); ``xxhash64`` is
    the cheaper choice for very large tables and equally independent of partitioning.
    """
    if fn == "xxhash64":
        return F.pmod(F.xxhash64(F.lit(seed), *[as_col(c) for c in cols]), F.lit(2**32))
    if fn != "md5":
        raise ValueError(f"unknown hash {fn!r}")
    text = F.concat_ws(":", F.lit(str(seed)), *[as_col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_bucket(seed: int, *cols, buckets: int = 1000, fn: str = "md5") -> Column:
    """``hash_key`` folded into ``buckets`` equal bins."""
    return hash_key(seed, *cols, fn=fn) % F.lit(buckets)
