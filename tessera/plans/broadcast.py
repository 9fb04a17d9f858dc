"""Broadcast only what is proven small.

``broadcast_if_small`` counts at most ``max_rows + 1`` rows of a dimension before hinting a
broadcast; beyond the bound the plain DataFrame is returned and Spark (with AQE, which
re-plans joins from runtime sizes) chooses a shuffle join instead. Large or data-dependent
sides are never hinted: AQE converts them to broadcast joins itself when their measured
shuffle output is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 100_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. Reads no more than ``max_rows + 1``."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` has at most ``max_rows`` rows, else ``df`` unchanged."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df
