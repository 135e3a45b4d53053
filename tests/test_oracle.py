"""Every core query beside its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from grainloom.plans import catalogue
from tools_verify import norm


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_same_rows(spark, sf, con, name):
    df = catalogue.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    r = con.execute(catalogue.ORACLE[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(tuple(norm(x[i]) for i in at) for x in r.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE)))
def test_runs(spark, sf, name):
    assert catalogue.QUERIES[name](spark, sf).count() >= 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
