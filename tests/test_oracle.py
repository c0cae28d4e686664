"""Every query that has SQL gives the rows that DuckDB gives."""

import os

import duckdb
import pandas as pd
import pytest

from folioforge import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


def rows(df: pd.DataFrame) -> list:
    def plain(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        return round(float(v), 9) if isinstance(v, float) else v if isinstance(v, (str, bool)) else int(v)

    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.sql(SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
