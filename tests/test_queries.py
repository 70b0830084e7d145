"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from cellweave.plans import catalog

FOLDER = Path("/root/testdata/sf0.001")
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def rows(df):
    df = df[sorted(df.columns)]
    plain = df.astype(object).where(df.notna(), None)
    return list(df.columns), sorted(map(repr, plain.itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, str(FOLDER)).toPandas()
    assert rows(got) == rows(duck.sql(SQL[name]).df())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["word", "cnt"]
