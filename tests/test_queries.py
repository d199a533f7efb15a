"""Every query that has SQL, against DuckDB on the smallest tables."""

import importlib
import os
from pathlib import Path

import duckdb
import pytest

entry = importlib.import_module("__spark_entry__")
FOLDER = os.environ.get("ORDERMILL_TESTDATA", "/root/testdata/sf0.001")


def normal(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]").astype(str)
    df = df.astype(object).where(df.notna(), None)
    one = lambda x: "" if x is None else f"{float(x):.6f}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    return sorted(tuple(map(one, r)) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for p in Path(FOLDER).glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, FOLDER).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
def test_entry(spark):
    assert entry.entry(spark).columns == ["field", "row_id", "value_utc"]
