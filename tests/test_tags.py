from pyspark.sql import functions as F

from conftest import rows
from tessera.functions.text import decode_tags, has_tags, photo_label, split_genres
from tessera.operators import tags

BOX_SCHEMA = "code string, ord int, min_lon double, min_lat double, max_lon double, max_lat double, c_lon double, c_lat double"


def test_decode_tags_cases(spark):
    cases = ["", ",", "a,,b,", "a%2Cb", "a+b", "%zz", "x,x,y", "a,b,,", ",a"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = {r.t: (r.tags, r.ok) for r in df.select("t", decode_tags("t").alias("tags")).select(
        "t", "tags", has_tags("tags").alias("ok")).collect()}
    assert got[""] == ([""], False)
    assert got[","] == ([""], False)
    assert got["a,,b,"] == (["a", "", "b"], True)
    assert got["a%2Cb"] == (["a", "b"], True)
    assert got["a+b"] == (["a b"], True)
    assert got["%zz"] == (None, False)
    assert got["x,x,y"] == (["x", "x", "y"], True)
    assert got["a,b,,"] == (["a", "b"], True)
    assert got[",a"] == (["", "a"], True)


def test_split_genres_and_label(spark):
    df = spark.createDataFrame([("Action|Comedy|", ["a", "", "b"])], "g string, t array<string>")
    r = df.select(split_genres("g").alias("s"), photo_label(F.lit("FR"), F.col("t")).alias("l")).first()
    assert r.s == ["Action", "Comedy"] and r.l == "(FR, a, , b)"


def _pics(spark):
    photos = spark.createDataFrame(
        [
            (1, 5.0, 5.0, "a,b,a"),
            (2, 6.0, 6.0, "b"),
            (3, 15.0, 5.0, "a%2Cc"),
            (4, 50.0, 50.0, "a"),  # no country
            (5, 5.0, 5.0, ""),  # no tags
            (6, 5.0, 5.0, "%zz"),  # undecodable
        ],
        "photo_id long, longitude float, latitude float, user_tags string",
    )
    boxes = spark.createDataFrame(
        [("A", 0, 0.0, 0.0, 10.0, 10.0, 5.0, 5.0), ("B", 1, 10.0, 0.0, 20.0, 10.0, 15.0, 5.0)], BOX_SCHEMA
    )
    return tags.pictures(photos, boxes)


def test_pictures_filter(spark):
    assert [r[0] for r in rows(_pics(spark), "photo_id")] == [1, 2, 3]


def test_country_stats(spark):
    p = _pics(spark)
    assert rows(tags.country_count(p)) == [("A", 2), ("B", 1)]
    freq = rows(tags.country_tag_freq(p))
    assert freq == [("A", "a", 2), ("A", "b", 2), ("B", "a", 1), ("B", "c", 1)]
    # frequencies add up to the long list of tags
    assert sum(f[2] for f in freq) == tags.country_tags(p).count()
    m = {r.country: r.freq for r in tags.tag_freq_map(tags.country_tag_freq(p)).collect()}
    assert m == {"A": {"a": 2, "b": 2}, "B": {"a": 1, "c": 1}}
    assert rows(tags.label(p).select("photo_id", "label")) == [(1, "(A, a, b, a)"), (2, "(A, b)"), (3, "(B, a, c)")]


def test_text_lines_to_tag_counts(spark, tmp_out):
    from tessera.sources.readers import parse_photo_lines, read_lines

    def line(pid, lon, lat, t):
        return "\t".join([str(pid)] + [""] * 7 + [t, "", str(lon), str(lat)] + [""] * 11)

    with open(f"{tmp_out}/p.txt", "w") as f:
        f.write("\n".join([line(1, 5, 5, "a%2Cb"), line(2, 5, 5, "a"), "3\tshort", line(4, "x", 5, "a")]) + "\n")
    boxes = spark.createDataFrame([("A", 0, 0.0, 0.0, 10.0, 10.0, 5.0, 5.0)], BOX_SCHEMA)
    pics = tags.pictures(parse_photo_lines(read_lines(spark, f"{tmp_out}/p.txt")), boxes, keep=())
    assert rows(tags.country_tag_freq(pics)) == [("A", "a", 2), ("A", "b", 1)]
