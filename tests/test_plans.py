from tessera.plans.inspect import physical_operators, plan_string
from tessera.plans.queries import REGISTRY


def test_projection_and_filter_reach_the_scan(spark, sf_dir):
    text = plan_string(REGISTRY["ratings_norm_max"](spark, sf_dir))
    # only the three needed lineitem columns are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text


def test_top_k_is_take_ordered(spark, sf_dir):
    for name in ("popular_items", "knn_users", "photo_head"):
        assert "TakeOrderedAndProject" in physical_operators(REGISTRY[name](spark, sf_dir)), name


def test_titles_join_broadcasts_the_top_k(spark):
    """With Spark's own broadcasts off, the hints alone must keep the item table in place."""
    from tessera.operators.ratings import with_titles

    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {n: spark.conf.get(n) if n == names[0] else None for n in names}
    try:
        for n in names:
            spark.conf.set(n, "-1")
        items = spark.range(1000).selectExpr("id as item_id", "cast(id as string) as title")
        top = spark.createDataFrame([(3, 9), (5, 8), (2000, 7)], "item_id long, n long")
        got = with_titles(top, items)
        text = physical_operators(got)
        assert text.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in text
        assert sorted((r.item_id, r.n, r.title) for r in got.collect()) == [(3, 9, "3"), (5, 8, "5"), (2000, 7, None)]
    finally:
        for n, v in old.items():
            spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def test_counting_photos_takes_one_exchange(spark, sf_dir):
    assert physical_operators(REGISTRY["photo_count"](spark, sf_dir)).count("Exchange") == 1


def test_appended_rows_are_seen(spark, tmp_out):
    from tessera.sources.readers import read_table

    spark.range(10).write.parquet(f"{tmp_out}/t.parquet")
    assert read_table(spark, tmp_out, "t").count() == 10
    spark.range(5).write.mode("append").parquet(f"{tmp_out}/t.parquet")
    assert read_table(spark, tmp_out, "t").count() == 15


def test_license_table_is_broadcast(spark, sf_dir):
    assert "BroadcastHashJoin" in physical_operators(REGISTRY["photo_nonderivative"](spark, sf_dir))


def test_tag_frequency_aggregates_partially(spark, sf_dir):
    text = plan_string(REGISTRY["country_tag_freq"](spark, sf_dir))
    assert "partial_count" in text


def test_per_user_join_is_salted_only_where_a_user_is_hot(spark, sf_dir):
    from tessera.operators.ratings import with_user_avg

    assert "_salt" not in plan_string(REGISTRY["ratings_norm_user"](spark, sf_dir))
    hot = spark.range(9000).selectExpr("if(id % 4 > 0, 7, id) as user_id", "id as item_id", "1.0 as rating")
    assert "_salt" in plan_string(with_user_avg(hot))
