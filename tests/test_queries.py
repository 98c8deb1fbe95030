"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tallyloom import plans
from tallyloom.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
plans.load_all()
LIBRARY = plans.QUERIES  # the corpus queries have tests of their own
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return round(float(v), 6)
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "aging_bucket" in df.columns


@pytest.mark.parametrize("name", sorted(LIBRARY))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    assert sql is not None, "every registered query has an oracle"
    ddf = duck.execute(sql).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert _rows(sdf) == _rows(ddf)
