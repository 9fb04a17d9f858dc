"""Explicit schemas of the file inputs (no inference pass over the data)."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column layouts of the input files --------------------------------------
# Photo metadata, tab-separated, no header: 23 fields in file order.
PHOTO_COLUMNS = [
    ("photo_id", T.LongType()),
    ("user_id", T.StringType()),
    ("user_nickname", T.StringType()),
    ("date_taken", T.StringType()),
    ("date_uploaded", T.StringType()),
    ("device", T.StringType()),
    ("title", T.StringType()),
    ("description", T.StringType()),
    ("user_tags", T.StringType()),
    ("machine_tags", T.StringType()),
    ("longitude", T.FloatType()),
    ("latitude", T.FloatType()),
    ("accuracy", T.StringType()),
    ("url", T.StringType()),
    ("download_url", T.StringType()),
    ("license", T.StringType()),
    ("license_url", T.StringType()),
    ("server_id", T.StringType()),
    ("farm_id", T.StringType()),
    ("secret", T.StringType()),
    ("secret_original", T.StringType()),
    ("extension_original", T.StringType()),
    ("marker", T.ByteType()),
]

# Field positions used when a photo line is parsed as raw text.
PHOTO_FIELD_TAGS = 8
PHOTO_FIELD_LON = 10
PHOTO_FIELD_LAT = 11

# License properties table, tab-separated with a header.
LICENSE_COLUMNS = [
    "Name",
    "Attribution",
    "Noncommercial",
    "NonDerivative",
    "ShareAlike",
    "PublicDomainDedication",
    "PublicDomainWork",
]

# Credit table, comma-separated, no header: label first, then 20 features.
CREDIT_COLUMNS = [
    "creditability",
    "balance", "duration", "history", "purpose", "amount",
    "savings", "employment", "instPercent", "sexMarried", "guarantors",
    "residenceDuration", "assets", "age", "concCredit", "apartment",
    "credits", "occupation", "dependents", "hasPhone", "foreign",
]
CREDIT_LABEL = "creditability"
# Columns holding one-based codes, shifted to zero-based when parsed.
CREDIT_SHIFTED = [
    "balance", "savings", "employment", "sexMarried", "guarantors",
    "residenceDuration", "assets", "concCredit", "apartment",
    "credits", "occupation", "dependents", "hasPhone", "foreign",
]
# --- end of fixed values -----------------------------------------------------------------

PHOTO_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in PHOTO_COLUMNS])

RATINGS_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("movieId", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

MOVIES_SCHEMA = T.StructType(
    [
        T.StructField("movieId", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ]
)

USER_INPUT_SCHEMA = T.StructType(
    [
        T.StructField("movieId", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("rating", T.IntegerType()),
    ]
)

CREDIT_SCHEMA = T.StructType([T.StructField(n, T.DoubleType()) for n in CREDIT_COLUMNS])

BOX_SCHEMA = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("ord", T.IntegerType()),
        T.StructField("min_lon", T.DoubleType()),
        T.StructField("min_lat", T.DoubleType()),
        T.StructField("max_lon", T.DoubleType()),
        T.StructField("max_lat", T.DoubleType()),
        T.StructField("c_lon", T.DoubleType()),
        T.StructField("c_lat", T.DoubleType()),
    ]
)
