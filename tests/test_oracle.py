"""Every query of the catalogue against its DuckDB SQL on the smallest tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest
from sentryloom.plans.catalog import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for p in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    if hasattr(x, "as_tuple"):
        return round(float(x), 6)
    return x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    got = df.collect()
    if name not in ORACLE_SQL:
        assert df.columns
        return
    want = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, got) == rows(names, want.fetchall())
