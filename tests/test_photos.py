from pyspark.sql import types as T

from conftest import rows
from tessera.operators import photos
from tessera.sources import readers, schemas, sinks
from tessera.sources.testdata import LICENSE_ROWS

SCHEMA = "photo_id long, longitude float, latitude float, license string, marker tinyint"


def _photos(spark):
    data = [
        (1, 2.0, 48.0, "Attribution License", 0),
        (2, -1.0, 48.0, "Attribution License", 0),  # longitude invalid alone
        (3, 2.0, -1.0, "Attribution License", 0),  # latitude invalid alone
        (4, 2.0, 48.0, "", 0),  # empty license
        (5, 2.0, 48.0, None, 0),  # missing license
        (6, None, 48.0, "Attribution License", 0),  # missing coordinate
        (7, 2.0, 48.0, "Attribution-NoDerivs License", 1),  # a video
        (8, 2.0, 48.0, "Attribution-NoDerivs License", None),  # unknown marker
        (9, 3.0, 49.0, "Attribution-NoDerivs License", 0),
        (10, 3.0, 49.0, "No such license", 0),
    ]
    return spark.createDataFrame(data, SCHEMA)


def _licenses(spark, rows_=LICENSE_ROWS, name_col="Name"):
    cols = [name_col] + schemas.LICENSE_COLUMNS[1:]
    return spark.createDataFrame(rows_, T.StructType([T.StructField(c, T.StringType()) for c in cols]))


def test_project_keeps_photos_only(spark):
    out = photos.photo_project(_photos(spark))
    assert out.columns == ["photo_id", "longitude", "latitude", "license"]
    assert [r[0] for r in rows(out, "photo_id")] == [1, 2, 3, 4, 5, 6, 9, 10]


def test_interesting_drops_invalid_and_null(spark):
    out = photos.interesting(photos.photo_project(_photos(spark)))
    assert [r[0] for r in rows(out, "photo_id")] == [1, 9, 10]


def test_nonderivative_join(spark):
    out = photos.nonderivative(photos.interesting(photos.photo_project(_photos(spark))), _licenses(spark))
    assert [r[0] for r in rows(out, "photo_id")] == [9]
    assert out.columns == ["photo_id", "longitude", "latitude", "license"]


def test_license_name_case_and_duplicates(spark):
    dup = list(LICENSE_ROWS) + [LICENSE_ROWS[1]]
    out = photos.nonderivative(photos.photo_project(_photos(spark)), _licenses(spark, dup, "name"))
    # photo 9 twice (duplicate license row multiplies), photos 7/8 are not photos
    assert [r[0] for r in rows(out, "photo_id")] == [9, 9]


def test_exactly_two_nonderivative_licenses(spark):
    lic = _licenses(spark)
    assert lic.filter("try_cast(NonDerivative as int) = 1").count() == 2


def test_read_photos_and_licenses(spark, tmp_out):
    line = "\t".join(
        ["42", "u", "nick", "2010-01-01", "1", "cam", "t", "d", "a%2Cb", "", "2.35", "48.85", "16", "url", "dl",
         "Attribution License", "lurl", "1", "2", "s", "so", "jpg", "0"]
    )
    with open(f"{tmp_out}/p.txt", "w") as f:
        f.write(line + "\n" + "43\tshort\n")
    p = readers.read_photos(spark, f"{tmp_out}/p.txt")
    assert p.schema == schemas.PHOTO_SCHEMA
    got = {r.photo_id: r for r in p.collect()}
    assert abs(got[42].latitude - 48.85) < 1e-5 and got[42].marker == 0 and got[42].user_tags == "a%2Cb"
    assert got[43].longitude is None and got[43].marker is None
    with open(f"{tmp_out}/l.txt", "w") as f:
        f.write("\t".join(schemas.LICENSE_COLUMNS) + "\n")
        f.write("A License\t1\t1\t0\t0\t0\t0\t0\n")  # one field too many
        f.write("B License\t1\t0\t1\t0\t0\t0\n")
    lic = readers.read_licenses(spark, f"{tmp_out}/l.txt")
    assert lic.columns == schemas.LICENSE_COLUMNS
    assert rows(lic, "Name", "NonDerivative") == [("A License", "0"), ("B License", "1")]


def test_tsv_sink_without_success_marker(spark, tmp_out):
    import os

    df = photos.photo_project(_photos(spark))
    sinks.write_tsv(df, f"{tmp_out}/out", single_file=True)
    files = os.listdir(f"{tmp_out}/out")
    assert "_SUCCESS" not in files
    assert len([f for f in files if f.endswith(".csv")]) == 1
    back = spark.read.csv(f"{tmp_out}/out", sep="\t", header=True)
    assert back.columns == df.columns and back.count() == df.count()


def test_parse_photo_lines(spark):
    lines = spark.createDataFrame(
        [("\t".join(["1"] * 8 + ["a,b", "", "2.5", "48.5"]),), ("only\tthree\tfields",), ("x\t" * 10 + "abc",)],
        "value string",
    )
    out = readers.parse_photo_lines(lines).collect()
    assert (out[0].latitude, out[0].longitude, out[0].user_tags) == (48.5, 2.5, "a,b")
    assert out[1].latitude is None and out[1].user_tags == ""
    assert out[2].latitude is None  # "abc" is not a number
