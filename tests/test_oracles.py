"""Every query with SQL gives DuckDB's rows at the smallest size."""

import os

import duckdb
import pandas as pd
import pytest

from spliceframe.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def rows(df):
    df = df[sorted(df.columns)]
    plain = lambda v: None if pd.isna(v) else f"{v:.6g}" if isinstance(v, float) and v != int(v) else str(int(v)) if isinstance(v, float) or "int" in type(v).__name__ else str(v)
    return sorted(str([plain(v) for v in r]) for r in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
    spark.catalog.clearCache()
