import os

import pytest

from conftest import rows
from tessera.sources import readers, sinks


def test_user_ratings_csv_roundtrip(spark, tmp_out):
    df = spark.createDataFrame(
        [(1, 'Heat, The', 5), (2, 'Say "Hi"', 3), (3, "Plain", 0)], "item_id long, title string, rating int"
    )
    sinks.write_user_ratings(df, f"{tmp_out}/u")
    back = readers.read_user_input(spark, f"{tmp_out}/u")
    assert rows(back) == [(1, "Heat, The", 5), (2, 'Say "Hi"', 3)]  # rating 0 not written


def test_report_sink(spark, tmp_out):
    rep = spark.createDataFrame([(8, 20, 0.01, 0.5)], "rank int, iteration int, lambda double, mse double")
    sinks.write_report(rep, f"{tmp_out}/r")
    part = [f for f in os.listdir(f"{tmp_out}/r") if f.endswith(".csv")][0]
    with open(f"{tmp_out}/r/{part}") as f:
        assert f.read().splitlines() == ["rank iteration lambda mse", "8 20 0.01 0.5"]


def test_movies_and_ratings_readers(spark, tmp_out):
    with open(f"{tmp_out}/m.csv", "w") as f:
        f.write('movieId,title,genres\n1,"Heat, The (1995)",Action|Crime\n2,Toy Story,(no genres listed)\n')
    with open(f"{tmp_out}/r.csv", "w") as f:
        f.write("userId,movieId,rating,timestamp\n1,1,4.5,100\n2,2,3.0,200\n")
    assert rows(readers.read_movies(spark, f"{tmp_out}/m.csv")) == [
        (1, "Heat, The (1995)", "Action|Crime"), (2, "Toy Story", "(no genres listed)")]
    assert rows(readers.read_ratings(spark, f"{tmp_out}/r.csv")) == [(1, 1, 4.5), (2, 2, 3.0)]
    assert rows(readers.read_ratings(spark, f"{tmp_out}/r.csv", infer_schema=True)) == [(1, 1, 4.5), (2, 2, 3.0)]


def test_read_boxes(spark, tmp_out):
    with open(f"{tmp_out}/b.csv", "w") as f:
        f.write("code,ord,min_lon,min_lat,max_lon,max_lat,c_lon,c_lat\nAA,0,0,0,1,1,0.5,0.5\nBB,1,0,0,1,1,0.5,0.5\n")
    b = readers.read_boxes(spark, f"{tmp_out}/b.csv").collect()
    assert [x.code for x in sorted(b, key=lambda x: x.ord)] == ["AA", "BB"]
    with open(f"{tmp_out}/c.csv", "w") as f:
        f.write("code,min_lon,min_lat,max_lon,max_lat,c_lon,c_lat\nAA,0,0,1,1,0.5,0.5\n")
    with pytest.raises(ValueError, match="ord"):
        readers.read_boxes(spark, f"{tmp_out}/c.csv")


def test_grid_report_format(spark, tmp_out):
    from tessera.operators.als import report_table

    rep = spark.createDataFrame([(8, 20, 0.01, 0.6434242, 10, "x"), (12, 30, 10.0, 13.531052, 10, "y")],
                                "rank int, iteration int, lambda double, mse double, n long, label string")
    sinks.write_report(report_table(rep), f"{tmp_out}/g")
    part = [f for f in os.listdir(f"{tmp_out}/g") if f.endswith(".csv")][0]
    with open(f"{tmp_out}/g/{part}") as f:
        assert f.read().splitlines() == ["rank iteration lambda mse", "8 20 0.01 0.643424", "12 30 10.00 13.531052"]
