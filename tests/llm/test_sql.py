"""Queries of this folder that have a DuckDB statement."""

import duckdb
import pytest

from tessera.llm.queries import ORACLE, REGISTRY


def norm(rows):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_statement(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    mine = REGISTRY[name](spark, sf_dir).toArrow()
    theirs = con.sql(ORACLE[name]).to_arrow_table()
    cols = sorted(mine.column_names)
    assert sorted(theirs.column_names) == cols
    assert {f.name: str(f.type) for f in mine.schema} == {f.name: str(f.type) for f in theirs.schema}
    assert norm(zip(*(mine[c].to_pylist() for c in cols))) == norm(zip(*(theirs[c].to_pylist() for c in cols)))
