"""The subpackage's queries on the smallest tables, beside SQL where there is any."""

import glob
import os

import duckdb
import pytest

from grainloom.llm import queries as Q
from tools_verify import norm


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, sf, name):
    df = Q.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    if name in Q.ORACLE:
        c = duckdb.connect()
        for p in glob.glob(f"{sf}/*.parquet"):
            c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
        r = c.execute(Q.ORACLE[name])
        names = [d[0] for d in r.description]
        at = [names.index(x) for x in cols]
        assert got == sorted(tuple(norm(x[i]) for i in at) for x in r.fetchall())
    elif name.endswith("_found"):
        assert got
