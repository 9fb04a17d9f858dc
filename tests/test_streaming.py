import os

from conftest import rows
from tessera.streaming import start_tag_freq

BOX_SCHEMA = "code string, ord int, min_lon double, min_lat double, max_lon double, max_lat double, c_lon double, c_lat double"


def _line(pid, lon, lat, tags):
    f = [str(pid)] + [""] * 7 + [tags, "", str(lon), str(lat)] + [""] * 10 + ["0"]
    return "\t".join(f)


def test_stream_updates_counts(spark, tmp_out):
    src = f"{tmp_out}/in"
    os.makedirs(src)
    boxes = spark.createDataFrame([("A", 0, 0.0, 0.0, 10.0, 10.0, 5.0, 5.0)], BOX_SCHEMA)
    with open(f"{src}/a.tsv", "w") as f:
        f.write(_line(1, 5, 5, "x,y") + "\n" + _line(2, 50, 50, "x") + "\n")
    q = start_tag_freq(spark, src, boxes, query_name="tf_test", sink="memory", output_mode="complete", checkpoint=f"{tmp_out}/ckpt")
    try:
        q.processAllAvailable()
        assert rows(spark.table("tf_test")) == [("A", "x", 1), ("A", "y", 1)]
        with open(f"{src}/b.tsv", "w") as f:
            f.write(_line(3, 6, 6, "x%2Cz") + "\n")
        q.processAllAvailable()
        assert rows(spark.table("tf_test")) == [("A", "x", 2), ("A", "y", 1), ("A", "z", 1)]
    finally:
        q.stop()
