"""The driver's tables as delimited text, some lines of which don't fit, for the text scans.

Written to the shared folder by Spark and read back by the scans. Which lines are broken, and how, follows from keys:

| input | broken lines |
| --- | --- |
| photos (tab-separated, no header) | cut after 12 fields by ``key % 23``, a word for the longitude by ``% 29``, a field too many by ``% 31`` |
| ratings (CSV with a header) | a word for the rating by ``item % 41`` |
| movies (CSV with a header; titles hold commas and quotes) | a letter before the key by ``key % 43`` |
| credit (CSV, no header) | a word for the amount by ``key % 19``, the last field missing by ``% 37`` |
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import shared_path
from tessera.sources import testdata as td
from tessera.sources.schemas import CREDIT_COLUMNS, PHOTO_COLUMNS


def _path(spark: SparkSession, name: str) -> str:
    return shared_path(spark, "text", f"{name}-{uuid.uuid4().hex}")


def photo_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("photo_id")
    lon = F.when(k % 11 == 0, F.lit("-1.00")).otherwise(td._hundredths_text((k * 7919) % 36000 - 18000))
    lat = F.when(k % 17 == 0, F.lit("-1.00")).otherwise(td._hundredths_text((k * 104729) % 18000 - 9000))
    known = {"photo_id": k, "user_id": F.col("user_id"), "user_tags": F.col("user_tags"), "longitude": F.when(k % 29 == 0, F.lit("west")).otherwise(lon), "latitude": lat}
    known |= {"license": F.col("license"), "marker": F.col("marker")}
    fields = [F.coalesce(known[c].cast("string"), F.lit("")) if c in known else F.lit("") for c, _ in PHOTO_COLUMNS]
    line = F.concat_ws("\t", *fields)
    cut = F.concat_ws("\t", *fields[:12])
    return td.photos(spark, sf_dir).select(F.when(k % 23 == 0, cut).when(k % 31 == 0, F.concat(line, F.lit("\tmore"))).otherwise(line).alias("value"))


def credit_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.when(F.col("id") % 19 == 0, F.lit("much")).otherwise(F.col("amount").cast("string"))
    fields = [amount if c == "amount" else F.col(c).cast("string") for c in CREDIT_COLUMNS]
    line = F.concat_ws(",", *fields)
    return td.credit_raw(spark, sf_dir).select(F.when(F.col("id") % 37 == 0, F.concat_ws(",", *fields[:-1])).otherwise(line).alias("value"))


def ratings_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rating = F.when(F.col("item_id") % 41 == 0, F.lit("good")).otherwise(F.col("rating").cast("string"))
    return td.ratings(spark, sf_dir).select(F.col("user_id").alias("userId"), F.col("item_id").alias("movieId"), rating.alias("rating"), F.lit(0).alias("timestamp"))


def movies_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("item_id").cast("string")
    first = F.when(F.col("item_id") % 43 == 0, F.concat(F.lit("m"), key)).otherwise(key)
    title = F.concat(F.col("title"), F.lit(', a "part"'))
    return td.items(spark, sf_dir).select(first.alias("movieId"), title.alias("title"), "genres")


TEXTS = {"photos": photo_text, "credit": credit_text, "ratings": ratings_text, "movies": movies_text}


def written(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The path of an input, written as text: ``name`` of ``TEXTS``."""
    df, path = TEXTS[name](spark, sf_dir), _path(spark, name)
    if df.columns == ["value"]:
        df.write.text(path)
    else:
        df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


def loose_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings some of which lack an id or the rating."""
    r = td.ratings(spark, sf_dir)
    missing = {"user_id": F.col("item_id") % 53 == 0, "item_id": F.col("user_id") % 59 == 0, "rating": (F.col("user_id") + F.col("item_id")) % 47 == 0}
    return r.select(*[F.when(~missing[c], F.col(c)).alias(c) for c in r.columns])
