"""Adapters from the driver's parquet tables to the engine's inputs.

Each adapter is written twice, once as DataFrame code and once as a DuckDB SQL CTE (``SQL``),
so that oracle queries start from the same rows. Rules such as ``key % 6`` only assign
attribute values (a license, a marker, a tag spelling) to every row; no adapter drops,
samples or caps rows, so every query's work grows with the driver tables. Ratings sit on a half-star grid and all
derived numbers are small integers or halves, so sums are exact and the two engines agree
bit for bit.

| engine table | from | rule |
| --- | --- | --- |
| ratings(user_id, item_id, rating) | lineitem ⋈ orders | user = o_custkey, item = l_partkey, rating = ((q-1) % 9 + 2) / 2 |
| items(item_id, title, genres) | part | genres = words of p_name and p_type joined by ``|`` |
| points(id, lon, lat) | orders | coordinates spread by two multiplicative hashes of the key |
| boxes(code, ord, ...) | nation | 60° × 40° boxes placed by the nation key |
| photos(...) | orders | reference photo columns with invalid markers, licenses and encoded tags by key |
| photo_lines(value) | photos | the same photos as raw tab-separated text lines, some short or non-numeric |
| licenses(Name, ...) | fixed rows | the five licenses of the reference's license file |
| profile(item_id, title, rating) | ratings | the most active user's items, integer ratings, 0 = unknown |
| scored(id, label, score) | labels ⋈ documents | label = quality, score = n_chars |
| answers(id, raw) | orders | typed answers to check against a domain |
| user_factors(user_id, features) | ratings | how many ratings of each of four bands a user gave |
| item_factors(item_id, features) | ratings | the same per item |
| item_taste(item_id, features) | ratings | (ratings of 3 or more, lower ones) per item |
| forest(tree, node, ...) | fixed rows | three small trees over the credit columns |
| credit(id, 21 columns) | customer, orders, lineitem | one-based codes from balances and order aggregates |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.skew import join_per_key
from tessera.session import ensure_checkpoint_dir
from tessera.sources.readers import read_table
from tessera.sources.schemas import CREDIT_COLUMNS, CREDIT_LABEL, LICENSE_COLUMNS

# --- fixed values: the license table of the reference (file order, header order) ---------
LICENSE_ROWS = [
    ("Attribution License", "1", "0", "0", "0", "0", "0"),
    ("Attribution-NoDerivs License", "1", "0", "1", "0", "0", "0"),
    ("Attribution-NonCommercial-NoDerivs License", "1", "1", "1", "0", "0", "0"),
    ("Attribution-NonCommercial License", "1", "1", "0", "0", "0", "0"),
    ("Attribution-NonCommercial-ShareAlike License", "1", "1", "0", "1", "0", "0"),
]
# --- end of fixed values -----------------------------------------------------------------

# License names given to photos by ``key % 6``: four real ones, a NULL and an empty string.
PHOTO_LICENSES = [
    "Attribution License",
    "Attribution-NoDerivs License",
    "Attribution-NonCommercial-NoDerivs License",
    "Attribution-NonCommercial-ShareAlike License",
    None,
    "",
]

# A small forest: tree, node, feature, threshold, left, right, share of class 1 (eighths: sums are exact).
FOREST_NODES = [
    (0, 0, "balance", 1.0, 1, 2, None),
    (0, 1, "duration", 8.0, 3, 4, None),
    (0, 2, None, None, None, None, 0.875),
    (0, 3, None, None, None, None, 0.125),
    (0, 4, "age", 40.0, 5, 6, None),
    (0, 5, None, None, None, None, 0.25),
    (0, 6, None, None, None, None, 0.5),
    (1, 0, "amount", 900000.0, 1, 2, None),
    (1, 1, None, None, None, None, 0.375),
    (1, 2, "savings", 2.0, 3, 4, None),
    (1, 3, None, None, None, None, 0.625),
    (1, 4, None, None, None, None, 0.75),
    (2, 0, None, None, None, None, 0.5),
]

PROFILE_USER_ID = -1  # reserved id of the injected user (driver customer keys start at 0)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    q = F.floor("l_quantity").cast("int")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (((q - 1) % 9 + 2).cast("double") / 2).alias("rating"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _t(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.concat_ws("|", F.regexp_replace("p_name", " ", "|"), F.col("p_type")).alias("genres"),
    )


def _lon(key):
    return ((key * 7919) % 36000).cast("double") / 100 - 180


def _lat(key):
    return ((key * 104729) % 18000).cast("double") / 100 - 90


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return _t(spark, sf_dir, "orders").select(k.alias("id"), _lon(k).alias("lon"), _lat(k).alias("lat"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    min_lon = ((k * 37) % 300 - 180).cast("double")
    min_lat = ((k * 23) % 120 - 90).cast("double")
    return (
        _t(spark, sf_dir, "nation")
        .select(
            F.col("n_name").alias("code"),
            k.alias("ord"),
            min_lon.alias("min_lon"),
            min_lat.alias("min_lat"),
            (min_lon + 60).alias("max_lon"),
            (min_lat + 40).alias("max_lat"),
        )
        .withColumn("c_lon", (F.col("min_lon") + F.col("max_lon")) / 2)
        .withColumn("c_lat", (F.col("min_lat") + F.col("max_lat")) / 2)
    )


def licenses(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in LICENSE_COLUMNS])
    return spark.createDataFrame(LICENSE_ROWS, schema)


def photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    prio = F.regexp_replace(F.lower("o_orderpriority"), " ", "+")
    status = F.lower("o_orderstatus")
    lic = F.lit(None).cast("string")
    for i in reversed(range(len(PHOTO_LICENSES))):
        lic = F.when(k % 6 == i, F.lit(PHOTO_LICENSES[i]).cast("string")).otherwise(lic)
    tags_by_5 = (
        F.when(k % 5 == 0, F.concat(prio, F.lit(","), status))
        .when(k % 5 == 1, F.concat(prio, F.lit("+"), status))
        .when(k % 5 == 2, F.concat(prio, F.lit("%2C"), status, F.lit(",")))
        .when(k % 5 == 3, F.lit(""))
        .otherwise(F.concat(prio, F.lit(",,"), status, F.lit(","), prio))
    )
    tags = F.when(k % 7 == 6, F.concat(F.lit("%zz"), prio)).otherwise(tags_by_5)
    return _t(spark, sf_dir, "orders").select(
        k.alias("photo_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.when(k % 11 == 0, F.lit(-1.0)).otherwise(_lon(k)).cast("float").alias("longitude"),
        F.when(k % 17 == 0, F.lit(-1.0)).otherwise(_lat(k)).cast("float").alias("latitude"),
        lic.alias("license"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(k % 2).cast("tinyint").alias("marker"),
        tags.alias("user_tags"),
    )


def _hundredths_text(v):
    """Text of an integer count of hundredths, e.g. -1234 → "-12.34" (same in both engines)."""
    a = F.abs(v)
    return F.concat(
        F.when(v < 0, F.lit("-")).otherwise(F.lit("")),
        (a / 100).cast("long").cast("string"),
        F.lit("."),
        F.lpad((a % 100).cast("string"), 2, "0"),
    )


def photo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tab-separated photo lines (``value``), 12 fields or fewer: id, blanks, tags at 8,
    longitude at 10, latitude at 11. Every 23rd line is cut short and every 29th has a
    non-numeric longitude."""
    k = F.col("o_orderkey")
    p = photos(spark, sf_dir)
    lon = _hundredths_text((k * 7919) % 36000 - 18000)
    lat = _hundredths_text((k * 104729) % 18000 - 9000)
    lon = F.when(k % 29 == 0, F.lit("abc")).otherwise(lon)
    full = F.concat_ws("\t", k.cast("string"), *[F.lit("")] * 7, F.col("user_tags"), F.lit(""), lon, lat)
    short = F.concat_ws("\t", k.cast("string"), F.lit(""), F.lit("x"))
    return p.withColumnRenamed("photo_id", "o_orderkey").select(
        F.when(k % 23 == 0, short).otherwise(full).alias("value")
    )


def profile_user(ratings_df: DataFrame) -> DataFrame:
    """One row: the user with the most rating rows (ties: smallest id)."""
    return (
        ratings_df.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "user_id")
        .limit(1)
        .select("user_id")
    )


def profile(spark: SparkSession, sf_dir: str, ratings_df: DataFrame | None = None) -> DataFrame:
    r = ratings(spark, sf_dir) if ratings_df is None else ratings_df
    mine = r.join(F.broadcast(profile_user(r)), "user_id", "left_semi")  # one row: bounded
    per_item = mine.groupBy("item_id").agg(F.max("rating").alias("best"))
    rating = F.when(F.col("item_id") % 5 == 0, F.lit(0)).otherwise(F.ceil("best").cast("int"))
    return per_item.join(items(spark, sf_dir).select("item_id", "title"), "item_id", "left").select(
        "item_id", "title", rating.alias("rating")
    )


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings with a per-item predictor on the half-star grid: floor(2·mean)/2."""
    r = ratings(spark, sf_dir)
    ensure_checkpoint_dir(spark)
    pred = (
        r.groupBy("item_id")
        .agg((F.floor(F.avg("rating") * 2) / 2).alias("prediction"), F.count(F.lit(1)).alias("n"))
        .checkpoint(eager=True)  # one row per item, read by the hot-key choice and the join
    )
    return join_per_key(r, pred.select("item_id", "prediction"), "item_id", counts=pred.select("item_id", "n"))


def _bands(ratings_df: DataFrame, key: str) -> DataFrame:
    """Whole numbers, so that products are exact in any order."""
    band = F.least(F.floor("rating"), F.lit(4))
    counts = [F.sum(F.when(band == b, 1).otherwise(0)).cast("double") for b in range(1, 5)]
    return ratings_df.groupBy(key).agg(F.array(*counts).alias("features"))


def user_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bands(ratings(spark, sf_dir), "user_id")


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bands(ratings(spark, sf_dir), "item_id")


def item_taste(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [F.sum(F.when(F.col("rating") >= 3, a).otherwise(b)).cast("double") for a, b in ((1, 0), (0, 1))]
    return ratings(spark, sf_dir).groupBy("item_id").agg(F.array(*counts).alias("features"))


def forest(spark: SparkSession) -> DataFrame:
    """The fixed trees as rows of ``operators.forest.NODE_SCHEMA``; features by their place among the credit columns."""
    names = [c for c in CREDIT_COLUMNS if c != CREDIT_LABEL]
    rows = [
        (t, n, None if f is None else names.index(f), c, None, left, right, None if p is None else [1 - p, p])
        for t, n, f, c, left, right, p in FOREST_NODES
    ]
    return spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, categories array<double>, left int, right int, shares array<double>")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = _t(spark, sf_dir, "labels").select("doc_id", "quality")
    doc = _t(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("quality").cast("double").alias("label"),
        F.col("n_chars").cast("double").alias("score"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    raw = (
        F.when(k % 4 == 0, F.col("o_orderpriority"))
        .when(k % 4 == 1, F.substring("o_orderpriority", 1, 1))
        .when(k % 4 == 2, F.lit(""))
        .otherwise((k % 8).cast("string"))
    )
    return _t(spark, sf_dir, "orders").select(k.alias("id"), raw.alias("raw"))


def credit_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: ``id`` and the 21 credit columns, codes still one-based."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    per_order = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("qty")
    )
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    per_cust = (
        o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.sum(F.coalesce("lines", F.lit(0))).alias("n_lines"),
            F.sum(F.coalesce("qty", F.lit(0.0))).alias("qty"),
            F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("n_done"),
            F.sum(F.floor("o_totalprice")).alias("amount"),
        )
    )
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    j = c.join(per_cust, c.c_custkey == per_cust.o_custkey, "left")
    key, nat = F.col("c_custkey"), F.col("c_nationkey")
    n_orders = F.coalesce("n_orders", F.lit(0))
    n_lines = F.coalesce("n_lines", F.lit(0))
    n_done = F.coalesce("n_done", F.lit(0))
    qty = F.coalesce("qty", F.lit(0.0))
    bal_band = F.floor((F.col("c_acctbal") + 1000) / 3000)
    cols = {
        "creditability": F.when(F.col("c_acctbal") > 0, 1).otherwise(0),
        "balance": bal_band + 1,
        "duration": n_orders,
        "history": n_done % 5,
        "purpose": nat % 10,
        "amount": F.coalesce("amount", F.lit(0)),
        "savings": key % 5 + 1,
        "employment": n_lines % 5 + 1,
        "instPercent": nat % 4 + 1,
        "sexMarried": key % 4 + 1,
        "guarantors": key % 3 + 1,
        "residenceDuration": (key + nat) % 4 + 1,
        "assets": F.when(F.col("c_mktsegment") == "BUILDING", 1).when(F.col("c_mktsegment") == "AUTOMOBILE", 2)
        .when(F.col("c_mktsegment") == "MACHINERY", 3).otherwise(4),
        "age": key % 50 + 19,
        "concCredit": n_done % 3 + 1,
        "apartment": nat % 3 + 1,
        "credits": F.floor(qty / 100) % 4 + 1,
        "occupation": key % 4 + 1,
        "dependents": key % 2 + 1,
        "hasPhone": (key + n_orders) % 2 + 1,
        "foreign": F.when(nat < 20, 1).otherwise(2),
    }
    return j.select(key.alias("id"), *[v.cast("double").alias(n) for n, v in cols.items()])


# --------------------------------------------------------------------------------------------
# The same adapters in DuckDB SQL, used as CTEs by the oracle queries.
# --------------------------------------------------------------------------------------------

_LON = "(CAST((o_orderkey * 7919) % 36000 AS DOUBLE) / 100 - 180)"
_LAT = "(CAST((o_orderkey * 104729) % 18000 AS DOUBLE) / 100 - 90)"
_PRIO = "replace(lower(o_orderpriority), ' ', '+')"
_STATUS = "lower(o_orderstatus)"


def _sql_str(v):
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def _bands_sql(key):
    counts = ", ".join(f"CAST(count(*) FILTER (least(floor(rating), 4) = {b}) AS DOUBLE)" for b in range(1, 5))
    return f"SELECT {key}, [{counts}] AS features FROM ratings GROUP BY {key}"


SQL: dict[str, str] = {
    "ratings": """
        SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
               CAST(((CAST(floor(l.l_quantity) AS INTEGER) - 1) % 9 + 2) AS DOUBLE) / 2 AS rating
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "items": """
        SELECT p_partkey AS item_id, p_name AS title,
               concat_ws('|', replace(p_name, ' ', '|'), p_type) AS genres
        FROM part""",
    "points": f"SELECT o_orderkey AS id, {_LON} AS lon, {_LAT} AS lat FROM orders",
    "boxes": """
        SELECT code, ord, min_lon, min_lat, max_lon, max_lat,
               (min_lon + max_lon) / 2 AS c_lon, (min_lat + max_lat) / 2 AS c_lat
        FROM (SELECT n_name AS code, n_nationkey AS ord,
                     CAST((n_nationkey * 37) % 300 - 180 AS DOUBLE) AS min_lon,
                     CAST((n_nationkey * 23) % 120 - 90 AS DOUBLE) AS min_lat,
                     CAST((n_nationkey * 37) % 300 - 180 AS DOUBLE) + 60 AS max_lon,
                     CAST((n_nationkey * 23) % 120 - 90 AS DOUBLE) + 40 AS max_lat
              FROM nation)""",
    "licenses": "SELECT * FROM (VALUES "
    + ", ".join("(" + ", ".join(_sql_str(v) for v in row) + ")" for row in LICENSE_ROWS)
    + ") AS t(" + ", ".join(LICENSE_COLUMNS) + ")",
    "photos": f"""
        SELECT o_orderkey AS photo_id,
               CAST(o_custkey AS VARCHAR) AS user_id,
               CAST(CASE WHEN o_orderkey % 11 = 0 THEN -1.0 ELSE {_LON} END AS FLOAT) AS longitude,
               CAST(CASE WHEN o_orderkey % 17 = 0 THEN -1.0 ELSE {_LAT} END AS FLOAT) AS latitude,
               CASE o_orderkey % 6 {' '.join(f'WHEN {i} THEN {_sql_str(v)}' for i, v in enumerate(PHOTO_LICENSES))} END AS license,
               CAST(CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 2 END AS TINYINT) AS marker,
               CASE WHEN o_orderkey % 7 = 6 THEN concat('%zz', {_PRIO})
                    WHEN o_orderkey % 5 = 0 THEN concat({_PRIO}, ',', {_STATUS})
                    WHEN o_orderkey % 5 = 1 THEN concat({_PRIO}, '+', {_STATUS})
                    WHEN o_orderkey % 5 = 2 THEN concat({_PRIO}, '%2C', {_STATUS}, ',')
                    WHEN o_orderkey % 5 = 3 THEN ''
                    ELSE concat({_PRIO}, ',,', {_STATUS}, ',', {_PRIO}) END AS user_tags
        FROM orders""",
    "photo_lines": """
        SELECT CASE WHEN photo_id % 23 = 0 THEN concat_ws(chr(9), CAST(photo_id AS VARCHAR), '', 'x')
               ELSE concat_ws(chr(9), CAST(photo_id AS VARCHAR), '', '', '', '', '', '', '', user_tags, '',
                    CASE WHEN photo_id % 29 = 0 THEN 'abc' ELSE
                      (CASE WHEN lo < 0 THEN '-' ELSE '' END) || CAST(abs(lo) // 100 AS VARCHAR) || '.'
                      || lpad(CAST(abs(lo) % 100 AS VARCHAR), 2, '0') END,
                    (CASE WHEN la < 0 THEN '-' ELSE '' END) || CAST(abs(la) // 100 AS VARCHAR) || '.'
                      || lpad(CAST(abs(la) % 100 AS VARCHAR), 2, '0')) END AS value
        FROM (SELECT photo_id, user_tags, (photo_id * 7919) % 36000 - 18000 AS lo,
                     (photo_id * 104729) % 18000 - 9000 AS la FROM photos)""",
    "profile_user": """
        SELECT user_id FROM ratings GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1""",
    "profile": """
        SELECT m.item_id, i.title,
               CASE WHEN m.item_id % 5 = 0 THEN 0 ELSE CAST(ceil(m.best) AS INTEGER) END AS rating
        FROM (SELECT item_id, max(rating) AS best FROM ratings
              WHERE user_id IN (SELECT user_id FROM profile_user) GROUP BY item_id) m
        LEFT JOIN items i ON m.item_id = i.item_id""",
    "predicted": """
        SELECT r.item_id, r.user_id, r.rating, p.prediction
        FROM ratings r JOIN (SELECT item_id, floor(avg(rating) * 2) / 2 AS prediction
                             FROM ratings GROUP BY item_id) p ON r.item_id = p.item_id""",
    "user_factors": _bands_sql("user_id"),
    "item_factors": _bands_sql("item_id"),
    "item_taste": """
        SELECT item_id, CAST(count(*) FILTER (rating >= 3) AS DOUBLE) AS x, CAST(count(*) FILTER (rating < 3) AS DOUBLE) AS y
        FROM ratings GROUP BY item_id""",
    "forest": "SELECT * FROM (VALUES "
    + ", ".join("(" + ", ".join("NULL" if v is None else _sql_str(v) if isinstance(v, str) else repr(v) for v in row) + ")" for row in FOREST_NODES)
    + ") AS t(tree, node, feature, threshold, l, r, p)",
    "scored": """
        SELECT l.doc_id AS id, CAST(l.quality AS DOUBLE) AS label,
               CAST(d.n_chars AS DOUBLE) AS score
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "answers": """
        SELECT o_orderkey AS id,
               CASE o_orderkey % 4 WHEN 0 THEN o_orderpriority WHEN 1 THEN substr(o_orderpriority, 1, 1)
                    WHEN 2 THEN '' ELSE CAST(o_orderkey % 8 AS VARCHAR) END AS raw
        FROM orders""",
    "credit_raw": """
        SELECT c.c_custkey AS id,
          CAST(CASE WHEN c.c_acctbal > 0 THEN 1 ELSE 0 END AS DOUBLE) AS creditability,
          CAST(floor((c.c_acctbal + 1000) / 3000) + 1 AS DOUBLE) AS balance,
          CAST(coalesce(a.n_orders, 0) AS DOUBLE) AS duration,
          CAST(coalesce(a.n_done, 0) % 5 AS DOUBLE) AS history,
          CAST(c.c_nationkey % 10 AS DOUBLE) AS purpose,
          CAST(coalesce(a.amount, 0) AS DOUBLE) AS amount,
          CAST(c.c_custkey % 5 + 1 AS DOUBLE) AS savings,
          CAST(coalesce(a.n_lines, 0) % 5 + 1 AS DOUBLE) AS employment,
          CAST(c.c_nationkey % 4 + 1 AS DOUBLE) AS instPercent,
          CAST(c.c_custkey % 4 + 1 AS DOUBLE) AS sexMarried,
          CAST(c.c_custkey % 3 + 1 AS DOUBLE) AS guarantors,
          CAST((c.c_custkey + c.c_nationkey) % 4 + 1 AS DOUBLE) AS residenceDuration,
          CAST(CASE c.c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'AUTOMOBILE' THEN 2
                    WHEN 'MACHINERY' THEN 3 ELSE 4 END AS DOUBLE) AS assets,
          CAST(c.c_custkey % 50 + 19 AS DOUBLE) AS age,
          CAST(coalesce(a.n_done, 0) % 3 + 1 AS DOUBLE) AS concCredit,
          CAST(c.c_nationkey % 3 + 1 AS DOUBLE) AS apartment,
          CAST(CAST(floor(coalesce(a.qty, 0) / 100) AS BIGINT) % 4 + 1 AS DOUBLE) AS credits,
          CAST(c.c_custkey % 4 + 1 AS DOUBLE) AS occupation,
          CAST(c.c_custkey % 2 + 1 AS DOUBLE) AS dependents,
          CAST((c.c_custkey + coalesce(a.n_orders, 0)) % 2 + 1 AS DOUBLE) AS hasPhone,
          CAST(CASE WHEN c.c_nationkey < 20 THEN 1 ELSE 2 END AS DOUBLE) AS "foreign"
        FROM customer c LEFT JOIN (
          SELECT o.o_custkey, count(*) AS n_orders, sum(coalesce(po.lines, 0)) AS n_lines,
                 sum(coalesce(po.qty, 0.0)) AS qty,
                 sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_done,
                 sum(CAST(floor(o.o_totalprice) AS BIGINT)) AS amount
          FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS qty
                                   FROM lineitem GROUP BY l_orderkey) po ON o.o_orderkey = po.l_orderkey
          GROUP BY o.o_custkey) a ON c.c_custkey = a.o_custkey""",
}


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the adapter CTEs it needs, in dependency order."""
    order = list(SQL)
    deps = {"photo_lines": ["photos"], "profile_user": ["ratings"], "profile": ["ratings", "items", "profile_user"], "predicted": ["ratings"], "user_factors": ["ratings"], "item_factors": ["ratings"], "item_taste": ["ratings"]}
    need: list[str] = []

    def add(n: str) -> None:
        for d in deps.get(n, []):
            add(d)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    need.sort(key=order.index)
    ctes = ",\n".join(f"{n} AS ({SQL[n]})" for n in need)
    return f"WITH {ctes}\n{body}"
