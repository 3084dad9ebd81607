"""Every registered query of the reference's operators against its DuckDB equivalent, over whole tables."""

import glob
import math
import os

import duckdb
import pytest

from docledger import plans

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        path = f"{f}/*.parquet" if os.path.isdir(f) else f
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{path}'")
    return con


def plain(x):
    return None if isinstance(x, float) and math.isnan(x) else round(x, 6) if isinstance(x, float) else x


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, tables, name):
    df = plans.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name in plans.ORACLES:
        rel = tables.sql(plans.ORACLES[name])
        assert sorted(rel.columns) == columns
        at = [rel.columns.index(c) for c in columns]
        assert got == sorted((tuple(plain(r[k]) for k in at) for r in rel.fetchall()), key=repr)
    else:
        assert got
