import os

import pytest

from tessera.sources import ledger as L
from tessera.sources.schemas import PHOTO_COLUMNS


def write(folder, name, lines):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def photo(key="7", lon="1.5", marker="0", tags="a,b", extra=()):
    known = {"photo_id": key, "longitude": lon, "latitude": "2.5", "marker": marker, "user_tags": tags, "license": 'no "quotes" here'}
    return "\t".join([*(known.get(c, "") for c, _ in PHOTO_COLUMNS), *extra])


def test_photos_and_their_rejects(spark, tmp_out):
    lines = [photo(), photo("x8"), photo("9", lon=""), photo("10", lon="east", marker="zwei"), "11\tonly", photo("12", extra=["more"]), photo("13", tags='say "a"\'')]
    path = write(tmp_out, "photos.tsv", lines)
    rows, rejects = L.scan_named(spark, path, "photos")
    assert sorted((r.photo_id, r.longitude, r.marker, r.user_tags) for r in rows.collect()) == [(7, 1.5, 0, "a,b"), (9, None, 0, "a,b"), (13, 1.5, 0, 'say "a"\'')]
    got = sorted((r.file, r.reason, r.column or "", r.line) for r in rejects.collect())
    want = [("bad value", "longitude", lines[3]), ("bad value", "photo_id", lines[1]), ("too few fields", "", lines[4]), ("too many fields", "", lines[5])]
    assert got == [("photos.tsv", *w) for w in want]


def test_rejects_are_found_whatever_is_selected(spark, tmp_out):
    path = write(tmp_out, "photos.tsv", [photo("1"), photo("2", lon="east")])
    rows, rejects = L.scan_named(spark, path, "photos")
    assert [r.photo_id for r in rows.select("photo_id").collect()] == [1]
    assert rejects.count() == 1 and rows.count() == 1


def test_quoted_fields_count_as_one(spark, tmp_out):
    lines = ["movieId,title,genres", '1,"Heat, and ""dust""",A|B', '"2","x","y"', 'm3,"a, b",C', "4,a, b,C", "5"]
    rows, rejects = L.scan_named(spark, write(tmp_out, "movies.csv", lines), "movies")
    assert sorted(map(tuple, rows.collect())) == [(1, 'Heat, and "dust"', "A|B"), (2, "x", "y")]
    got = sorted((r.reason, r.column or "") for r in rejects.collect())
    assert got == [("bad value", "movieId"), ("too few fields", ""), ("too many fields", "")]


def test_ratings_credit_and_licenses(spark, tmp_out):
    path = write(tmp_out, "ratings.csv", ["userId,movieId,rating,timestamp", "1,2,3.5,9", "1,2,good,9", "1,2,4.0,"])
    rows, rejects = L.scan_named(spark, path, "ratings")
    assert sorted(map(tuple, rows.collect())) == [(1, 2, 3.5), (1, 2, 4.0)] and rejects.first().column == "rating"
    path = write(tmp_out, "credit.csv", [",".join(["1"] * 21), ",".join(["1"] * 20), ",".join(["1"] * 20 + ["no"])])
    rows, rejects = L.scan_named(spark, path, "credit")
    assert rows.first().balance == 0 and rows.first().duration == 1 and rows.count() == 1
    assert sorted((r.reason, r.column or "", r.n) for r in L.summary(rejects).collect()) == [("bad value", "foreign", 1), ("too few fields", "", 1)]
    lines = ["\t".join(L.LAYOUTS["licenses"].schema.fieldNames()), "A\t1\t0\t0\t0\t0\t0", "B\t1\t0\t0\t0\t0\t0\t1"]
    rows, rejects = L.scan_named(spark, write(tmp_out, "licenses.tsv", lines), "licenses")
    assert [r.Name for r in rows.collect()] == ["A"] and rejects.first().reason == "too many fields"


@pytest.mark.parametrize("lines", [[], ["movieId,title,genres"]])
def test_files_without_rows(spark, tmp_out, lines):
    path = os.path.join(tmp_out, "movies.csv")
    with open(path, "w") as f:
        f.writelines(f"{x}\n" for x in lines)
    rows, rejects = L.scan_named(spark, path, "movies")
    assert rows.count() == 0 and rejects.count() == 0
