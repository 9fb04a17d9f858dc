"""Text scans that keep account of the lines that don't fit.

A permissive scan turns a bad field into a NULL and says nothing. Here every line that has too few or too many fields, or a
field that its column's type can't hold, goes to a ledger instead, with its file, the text as it stands, the reason and the
first column concerned. Both sides come from one scan with an explicit schema and Spark's corrupt-record column.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.codes import shift_codes
from tessera.sources import schemas as S

CORRUPT, FILE = "_corrupt", "_file"


class Layout(NamedTuple):
    schema: T.StructType
    sep: str = ","
    header: bool = False
    quote: str = '"'


#: The inputs by name. Tab-separated files are not quoted.
LAYOUTS = {
    "photos": Layout(S.PHOTO_SCHEMA, sep="\t", quote=""),
    "licenses": Layout(T.StructType([T.StructField(c, T.StringType()) for c in S.LICENSE_COLUMNS]), sep="\t", header=True, quote=""),
    "ratings": Layout(S.RATINGS_SCHEMA, header=True),
    "movies": Layout(S.MOVIES_SCHEMA, header=True),
    "user_input": Layout(S.USER_INPUT_SCHEMA, header=True),
    "credit": Layout(S.CREDIT_SCHEMA),
}


class Scan(NamedTuple):
    #: lines that fit, in the schema's columns
    rows: DataFrame
    #: ``file, reason, column, line``
    rejects: DataFrame


def scan(spark: SparkSession, path: str | list[str], layout: Layout) -> Scan:
    """Read delimited text. Reasons: ``too few fields``, ``too many fields``, ``bad value`` (then ``column`` is the first
    column whose field isn't empty and can't be read). Empty fields are NULL and fit."""
    full = T.StructType([*layout.schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(full).option("sep", layout.sep).option("header", layout.header).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("quote", layout.quote).option("escape", layout.quote)
    names = layout.schema.fieldNames()
    # Spark converts only the columns that are used, and a bad field elsewhere would go unseen: this condition, which always
    # holds, uses them all
    whole = F.xxhash64(*[f"`{c}`" for c in names]) >= F.lit(-(2**63))
    df = reader.csv(path).select("*", F.col("_metadata.file_name").alias(FILE)).where(whole)
    line = F.col(CORRUPT)
    if layout.quote:  # a quoted field counts as one, whatever it holds
        line = F.regexp_replace(line, '"(?:[^"]|"")*"', "q")
    fields = F.split(line, layout.sep)
    n = F.size(fields)
    unread = [F.when(F.col(f"`{c}`").isNull() & (F.coalesce(F.get(fields, F.lit(i)), F.lit("")) != ""), F.lit(c)) for i, c in enumerate(names)]
    reason = F.when(n < len(names), "too few fields").when(n > len(names), "too many fields").otherwise("bad value")
    column = F.when(n == len(names), F.coalesce(*unread))
    bad = df.where(F.col(CORRUPT).isNotNull())
    rejects = bad.select(F.col(FILE).alias("file"), reason.alias("reason"), column.alias("column"), F.col(CORRUPT).alias("line"))
    return Scan(df.where(F.col(CORRUPT).isNull()).select(*[f"`{c}`" for c in names]), rejects)


def scan_named(spark: SparkSession, path: str | list[str], name: str) -> Scan:
    """One of ``LAYOUTS``, with the rows as the plain reader of that input gives them."""
    rows, rejects = scan(spark, path, LAYOUTS[name])
    long = lambda c: F.col(c).cast("long")
    if name == "ratings":
        rows = rows.select(long("userId").alias("user_id"), long("movieId").alias("item_id"), "rating")
    elif name == "movies":
        rows = rows.select(long("movieId").alias("item_id"), "title", "genres")
    elif name == "user_input":
        rows = rows.select(long("movieId").alias("item_id"), "title", "rating")
    elif name == "credit":
        rows = shift_codes(rows, S.CREDIT_SHIFTED)
    return Scan(rows, rejects)


def summary(rejects: DataFrame) -> DataFrame:
    """``reason, column, n``"""
    return rejects.groupBy("reason", "column").agg(F.count(F.lit(1)).alias("n"))
