"""Every query of the library beside its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from voxloom.plans import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(value):
    return float(f"{value:.9g}") if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, tables, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    if name not in queries.SQL:
        assert got
        return
    rel = tables.sql(queries.SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert got == sorted(repr([plain(r[i]) for i in at]) for r in rel.fetchall())
