"""Queries of the subpackage against their SQL, at the smallest scale."""

from pathlib import Path

import duckdb
import pytest

from cellweave.llm import queries

FOLDER = Path("/root/testdata/sf0.001")
SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", SQL)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = queries.queries()[name](spark, str(FOLDER)).toPandas()
    want = con.sql(SQL[name]).df()[list(got.columns)]
    plain = lambda df: sorted(map(repr, df.astype(object).itertuples(index=False, name=None)))
    assert plain(got) == plain(want)
