"""The driver contract, and every oracle statement checked against its Spark query at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans.inspect import has_cartesian, uses_python
from tessera.plans.queries import REGISTRY

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
MODEL_QUERIES = {"als_fit", "als_mse", "als_grid", "als_recommend", "credit_fit", "credit_score", "credit_score_saved"}


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, float(v))
    if isinstance(v, (int, float)):
        return (1, "nan" if isinstance(v, float) and math.isnan(v) else float(v))
    return (2, str(v))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["country", "tag", "n"]
    assert df.count() > 0


def test_registry_shapes():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(REGISTRY) <= set(q)
    assert set(REGISTRY) - set(o) == MODEL_QUERIES


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(REGISTRY)))
def test_oracle(spark, sf_dir, con, name):
    mine = E.queries()[name](spark, sf_dir).toArrow()
    theirs = con.sql(E.oracle_sql()[name]).to_arrow_table()
    cols = sorted(mine.column_names)
    assert sorted(theirs.column_names) == cols
    # same value types column by column
    assert {f.name: str(f.type) for f in mine.schema} == {f.name: str(f.type) for f in theirs.schema}
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in mine.to_pylist())
    want = sorted(tuple(_norm(r[c]) for c in cols) for r in theirs.to_pylist())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - MODEL_QUERIES))
def test_plans_stay_in_the_jvm(spark, sf_dir, name):
    df = E.queries()[name](spark, sf_dir)
    assert not uses_python(df), name
    assert not has_cartesian(df), name


@pytest.mark.parametrize("name", ["geo_assign", "ratings_norm_user", "user_cosine", "auc_exact"])
def test_oracle_without_aqe(spark, sf_dir, con, name):
    """Skew salting and bounded broadcasts do not depend on AQE being on."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mine = E.queries()[name](spark, sf_dir).toArrow()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    theirs = con.sql(E.oracle_sql()[name]).to_arrow_table()
    cols = sorted(mine.column_names)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in mine.to_pylist())
    want = sorted(tuple(_norm(r[c]) for c in cols) for r in theirs.to_pylist())
    assert got == want
