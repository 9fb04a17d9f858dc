"""File scans. Every reader takes an explicit schema, so no pass is spent on inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.codes import shift_codes
from tessera.sources import schemas as S


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the driver's test data, as it is now (nothing is kept between calls)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_photos(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated photo metadata, no header, 23 typed columns.

    Empty or malformed numeric fields become NULL (permissive mode); short lines are padded
    with NULLs.
    """
    return spark.read.schema(S.PHOTO_SCHEMA).csv(path, sep="\t", header=False, mode="PERMISSIVE")


def read_licenses(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated license table with a header; every column a string, as in the file.

    Fields beyond the header are dropped by the permissive scan.
    """
    return spark.read.csv(path, sep="\t", header=True, inferSchema=False, mode="PERMISSIVE")


def read_ratings(spark: SparkSession, path: str, infer_schema: bool = False) -> DataFrame:
    """``userId,movieId,rating,timestamp`` CSV → ``user_id, item_id, rating``."""
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if infer_schema else reader.schema(S.RATINGS_SCHEMA)
    df = reader.csv(path)
    return df.select(
        F.col("userId").cast("long").alias("user_id"),
        F.col("movieId").cast("long").alias("item_id"),
        F.col("rating").cast("double").alias("rating"),
    )


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    """``movieId,title,genres`` CSV (quoted titles may hold commas) → ``item_id, title, genres``."""
    df = spark.read.schema(S.MOVIES_SCHEMA).csv(path, header=True, quote='"', escape='"')
    return df.select(F.col("movieId").cast("long").alias("item_id"), "title", "genres")


def read_user_input(spark: SparkSession, path: str) -> DataFrame:
    """``movieId,title,rating`` CSV of one user's ratings → ``item_id, title, rating``."""
    df = spark.read.schema(S.USER_INPUT_SCHEMA).csv(path, header=True, quote='"', escape='"')
    return df.select(F.col("movieId").cast("long").alias("item_id"), "title", "rating")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One string column ``value`` per text line."""
    return spark.read.text(path)


def parse_photo_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Raw photo lines → ``latitude, longitude`` (double) and the raw ``user_tags`` text.

    Short lines or non-numeric coordinates give NULL, not a failed job.
    """
    fields = F.split(F.col(col), "\t")
    return lines.select(
        F.get(fields, S.PHOTO_FIELD_LAT).try_cast("double").alias("latitude"),
        F.get(fields, S.PHOTO_FIELD_LON).try_cast("double").alias("longitude"),
        F.coalesce(F.get(fields, S.PHOTO_FIELD_TAGS), F.lit("")).alias("user_tags"),
    )


def read_credit(spark: SparkSession, path: str, shift: bool = True) -> DataFrame:
    """Headerless comma-separated credit rows, 21 doubles by position.

    Non-numeric fields become NULL. With ``shift`` the one-based code columns are made
    zero-based.
    """
    df = spark.read.schema(S.CREDIT_SCHEMA).csv(path, header=False, mode="PERMISSIVE")
    return shift_codes(df, S.CREDIT_SHIFTED) if shift else df


def read_boxes(spark: SparkSession, path: str) -> DataFrame:
    """Region boxes from a CSV with header ``code,ord,min_lon,min_lat,max_lon,max_lat,c_lon,c_lat``
    (in any order). ``ord`` is required: ties go to the smaller one, and rows read by several tasks have
    no order of their own."""
    df = spark.read.csv(path, header=True, inferSchema=False)
    if "ord" not in df.columns:
        raise ValueError("the box file needs an ord column: which of two equally near boxes wins")
    return df.select(
        F.col("code"),
        F.col("ord").cast("long").alias("ord"),
        *[F.col(c).cast("double").alias(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat", "c_lon", "c_lat")],
    )
