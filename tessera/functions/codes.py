"""Shift one-based category codes to zero-based ones."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shift_codes(df: DataFrame, cols: Iterable[str], by: float = 1.0) -> DataFrame:
    """Subtract ``by`` from each column in ``cols``; other columns pass through, order kept."""
    shifted = set(cols)
    missing = shifted - set(df.columns)
    if missing:
        raise ValueError(f"unknown columns: {sorted(missing)}")
    return df.select(
        *[(F.col(c) - F.lit(by)).alias(c) if c in shifted else F.col(c) for c in df.columns]
    )
