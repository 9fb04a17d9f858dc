from conftest import rows
from tessera.operators import validate


def test_validate_int_rating(spark):
    df = spark.createDataFrame([(x,) for x in ["3", "", "0", "6", "-1", "x", " 2", "+4", "2.5", None]], "raw string")
    got = {r.raw: (r.value, r.is_valid, r.reason) for r in validate.validate_int(df, "raw", 0, 5, blank_as=0).collect()}
    assert got["3"] == (3, True, None)
    assert got[""] == (0, True, None)
    assert got["6"] == (6, False, "out of range")
    assert got["-1"] == (-1, False, "out of range")
    assert got["x"] == (None, False, "not an integer")
    assert got[" 2"] == (None, False, "not an integer")
    assert got["+4"] == (4, True, None)
    assert got["2.5"] == (None, False, "not an integer")
    assert got[None] == (None, False, "blank")


def test_validate_int_allowed_and_any(spark):
    df = spark.createDataFrame([("3",), ("4",), ("",), ("123",)], "raw string")
    acc = {r.raw: r.is_valid for r in validate.validate_int(df, "raw", allowed=range(0, 4)).collect()}
    assert acc == {"3": True, "4": False, "": False, "123": False}
    dur = {r.raw: r.is_valid for r in validate.validate_int(df, "raw").collect()}
    assert dur == {"3": True, "4": True, "": False, "123": True}


def test_validate_choice_and_split(spark):
    df = spark.createDataFrame([("y",), ("N",), ("maybe",)], "raw string")
    checked = validate.validate_choice(df, "raw", ["Y", "N"])
    good, bad = validate.split_valid(checked)
    assert rows(good, "raw", "value") == [("N", "N"), ("y", "Y")]
    assert rows(bad, "raw", "reason") == [("maybe", "not a choice")]


def test_incomplete_rows_are_dropped_and_counted_in_one_pass(spark, tmp_out):
    from tessera.operators import validate

    rows = [(1, 2, 3.0), (None, 2, 3.0), (1, None, None), (None, None, None), (4, 5, float("nan"))]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    kept, rest, n = validate.write_complete(df, ["user_id", "item_id", "rating"], f"{tmp_out}/kept")
    assert n == {"rows": 5, "kept": 2, "null_user_id": 2, "null_item_id": 2, "null_rating": 2}
    assert sorted(r.user_id for r in kept.collect()) == [1, 4] and kept.schema == df.schema
    assert sorted((r.user_id or 0, r.item_id or 0) for r in rest.collect()) == [(0, 0), (0, 2), (1, 0)]
    for rows, want in ((df.limit(0), (0, 0, 0)), (df.where("user_id is null"), (2, 0, 2)), (df.where("user_id = 4"), (1, 1, 0))):
        n = validate.write_complete(rows, ["user_id"], f"{tmp_out}/{want}")[2]
        assert (n["rows"], n["kept"], n["null_user_id"]) == want
