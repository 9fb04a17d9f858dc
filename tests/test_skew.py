"""One key holding a third of all rows: results stay exact and the hot key is spread."""

from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import ratings as R
from tessera.plans import skew


def _skewed(spark, n=30000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 2000 + 100).alias("user_id"),
        (F.col("id") % 500).alias("item_id"),
        ((F.col("id") % 9) / 2 + 1).alias("rating"),
    )


def test_hot_keys_bounded(spark):
    df = _skewed(spark)
    counts = df.groupBy("user_id").count().withColumnRenamed("count", "n")
    hot = skew.hot_keys(counts, "user_id", "n", 8)
    assert hot == [(7, 3)]  # a third of 8 partitions; nobody else is hot
    uniform = spark.range(8000).selectExpr("id % 1000 as user_id").groupBy("user_id").count().withColumnRenamed("count", "n")
    assert skew.hot_keys(uniform, "user_id", "n", 200) == []


def test_salted_join_equals_plain_join_and_spreads(spark):
    df = _skewed(spark)
    avg = R.user_avg(df)
    plain = rows(df.join(avg.select("user_id", "avg_rating"), "user_id"))
    salted_df = skew.join_per_key(df, avg.select("user_id", "avg_rating"), "user_id", parts=8)
    assert rows(salted_df) == plain
    assert "_salt" not in salted_df.columns


def test_hot_rows_spread_evenly_over_the_salts(spark):
    df = _skewed(spark).repartition(4)
    salts = 3
    place = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns])
    sizes = [r["count"] for r in df.filter("user_id = 7").groupBy(F.pmod(place, F.lit(salts))).count().collect()]
    assert len(sizes) == salts and max(sizes) < 1.5 * sum(sizes) / salts


def test_above_avg_under_skew_matches_pandas(spark):
    df = _skewed(spark)
    pdf = df.toPandas()
    means = pdf.groupby("user_id")["rating"].transform("mean")
    want = sorted(map(tuple, pdf[pdf["rating"] >= means][["user_id", "item_id", "rating"]].itertuples(index=False)))
    assert rows(R.above_avg(df)) == want


def test_left_join_keeps_unmatched(spark):
    big = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d")], "k long, v string")
    small = spark.createDataFrame([(2, "x")], "k long, w string")
    out = skew.join_per_key(big, small, "k", how="left", parts=2)
    assert rows(out, "k", "v", "w") == [(1, "a", None), (1, "b", None), (1, "c", None), (2, "d", "x")]


def test_aqe_splits_a_popular_item_in_the_genre_join(spark):
    from tessera.operators import knn
    from tessera.plans.inspect import plan_string

    confs = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        liked = spark.range(20000).select(
            (F.col("id") % 1000).alias("user_id"),
            F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 400).alias("item_id"),
        )
        items = spark.range(400).select(F.col("id").alias("item_id"), F.lit("a|b|c").alias("genres"))
        pairs = liked.join(knn.item_genres(items), "item_id")
        got = pairs.collect()
        assert len(got) == 20000 * 3
        assert "skew" in plan_string(pairs, "formatted").lower()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
