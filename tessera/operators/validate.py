"""Domain checks on typed-in answers: each row is kept and marked, never dropped or failed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGER_PATTERN = r"^[+-]?[0-9]+$"  # what a JVM integer parse accepts (no spaces, no decimals)


def validate_int(
    df: DataFrame,
    col: str,
    lo: int | None = None,
    hi: int | None = None,
    allowed: Sequence[int] | None = None,
    blank_as: int | None = None,
) -> DataFrame:
    """Add ``value`` (int), ``is_valid`` and ``reason`` for an integer answer in ``col``.

    An empty answer becomes ``blank_as`` when given (e.g. 0 = "unknown"), else it is invalid.
    Reasons: ``blank``, ``not an integer``, ``out of range``; NULL when valid.
    """
    raw = F.col(col)
    parsed = F.when(raw.rlike(INTEGER_PATTERN), raw.try_cast("int"))
    value = F.when(raw == "", F.lit(blank_as).cast("int")).otherwise(parsed) if blank_as is not None else parsed
    in_domain = F.lit(True)
    if lo is not None:
        in_domain = in_domain & (value >= lo)
    if hi is not None:
        in_domain = in_domain & (value <= hi)
    if allowed is not None:
        in_domain = in_domain & value.isin(list(allowed))
    reason = (
        F.when(raw.isNull() | ((raw == "") & F.lit(blank_as is None)), F.lit("blank"))
        .when(value.isNull(), F.lit("not an integer"))
        .when(~in_domain, F.lit("out of range"))
    )
    return df.withColumn("value", value).withColumn("reason", reason).withColumn("is_valid", reason.isNull())


def validate_choice(df: DataFrame, col: str, choices: Sequence[str], case_insensitive: bool = True) -> DataFrame:
    """Add ``value`` (normalised answer), ``is_valid`` and ``reason`` for a fixed-choice answer."""
    raw = F.col(col)
    norm = F.upper(raw) if case_insensitive else raw
    opts = [c.upper() for c in choices] if case_insensitive else list(choices)
    reason = F.when(raw.isNull(), F.lit("blank")).when(~norm.isin(opts), F.lit("not a choice"))
    return (
        df.withColumn("value", F.when(reason.isNull(), norm))
        .withColumn("reason", reason)
        .withColumn("is_valid", reason.isNull())
    )


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows) of a checked table."""
    return checked.filter("is_valid"), checked.filter("NOT is_valid")


def write_complete(df: DataFrame, cols: Sequence[str], path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(rows in which none of ``cols`` is null, the others, counts), from one pass over ``df``, which writes both to ``path`` as
    Parquet. Counts: ``rows``, ``kept`` and for each column ``null_<column>``; they are taken from what has been written, and only the
    rows that were left out are read for them. (An ``Observation`` would count as well, but once a session has one, Spark 4.1
    can't send ``vector_to_array`` to its executors.)"""
    whole = F.lit(True)
    for c in cols:
        whole = whole & F.col(f"`{c}`").isNotNull()
    df.withColumn("__complete", whole).write.partitionBy("__complete").parquet(path)
    written = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("__complete", T.BooleanType())])).parquet(path)
    kept, rest = (written.where(side).drop("__complete") for side in (F.col("__complete"), ~F.col("__complete")))
    nulls = [F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(c) for c in cols]
    out = rest.agg(F.count(F.lit(1)).alias("rows"), *nulls).first()
    n = kept.count()
    return kept, rest, {"rows": n + out["rows"], "kept": n} | {f"null_{c}": out[c] for c in cols}
