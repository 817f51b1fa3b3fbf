"""Every query of the catalog against its SQL in DuckDB on the smallest tables."""

import numbers

import duckdb
import numpy as np
import pandas as pd
import pytest

from atlasloom.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events pages".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def shown(v):
    """A value's text; nullable integers come as floats from one side and as integers from the other."""
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
        return "NULL"
    return repr(float(v)) if isinstance(v, numbers.Number) and not isinstance(v, (bool, np.bool_)) else str(v)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(shown, r)) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
