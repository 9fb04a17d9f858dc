import os

from pyspark.sql import functions as F

from tessera.sources import publish as P


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}


def made(spark, rows):
    return spark.createDataFrame(rows, "k string, n int, v double")


ROWS = [("a", 1, 0.5), ("a", 2, None), ("b", 1, 2.0), (None, 3, 1.0), ("b", 1, 2.0)]


def test_a_repeated_write_changes_nothing(spark, tmp_out):
    path = f"{tmp_out}/out"
    df = made(spark, ROWS)
    assert P.publish(df, path, ["k"]) == (3, 0)
    before = files(path)
    assert P.publish(df.repartition(3).orderBy(F.desc("n")), path, ["k"]) == (0, 3)
    assert files(path) == before
    back = spark.read.schema("n int, v double, k string").parquet(path)
    assert sorted(map(str, back.select("k", "n", "v").collect())) == sorted(map(str, df.collect()))


def test_only_what_differs_is_written(spark, tmp_out):
    path = f"{tmp_out}/out"
    P.publish(made(spark, ROWS), path, ["k"])
    before = {f: t for f, t in files(path).items() if "k=a" in f}
    changed = made(spark, [("a", 1, 0.5), ("a", 2, None), ("b", 7, 2.0), ("c", 1, 1.0)])
    assert P.publish(changed, path, ["k"]) == (2, 1)
    assert before and all(files(path)[f] == t for f, t in before.items())
    back = spark.read.schema("n int, v double, k string").parquet(path)
    got = sorted((r.k or "", r.n) for r in back.collect())
    assert got == [("", 3), ("a", 1), ("a", 2), ("b", 7), ("c", 1)]  # what the table doesn't name stays
    assert {(r.n) for r in P.manifest(spark, path).collect()} == {1, 2} and P.manifest(spark, path).count() == 4


def test_a_run_that_broke_off_goes_on(spark, tmp_out):
    """Partitions were written, but not recorded: they are written again, and only they."""
    path = f"{tmp_out}/out"
    P.publish(made(spark, ROWS[:2]), path, ["k"])
    made(spark, ROWS[2:3]).write.mode("append").partitionBy("k").parquet(path)
    assert P.publish(made(spark, ROWS), path, ["k"]) == (2, 1)
    assert spark.read.parquet(path).count() == 5


def test_text_formats_and_several_columns(spark, tmp_out):
    path = f"{tmp_out}/out"
    df = made(spark, ROWS)
    assert P.publish(df, path, ["k", "n"], source="csv", sep="\t", header="true", nullValue="-").written == 4
    assert P.publish(df, path, ["k", "n"], source="csv", sep="\t", header="true", nullValue="-").written == 0
    back = spark.read.option("header", True).option("sep", "\t").csv(path)
    assert sorted((r.k or "", int(r.n)) for r in back.collect()) == sorted((k or "", n) for k, n, _ in ROWS)


def test_an_empty_table(spark, tmp_out):
    assert P.publish(made(spark, []), f"{tmp_out}/out", ["k"]) == (0, 0)
