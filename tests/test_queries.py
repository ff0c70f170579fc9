"""Every core query has the columns and rows of its SQL on the smallest tables."""

import glob
import os
import sys

import duckdb
import pytest

from quaverlake.plans.registry import ORACLES, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def norm(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    return str(v)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    order = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in order) for r in df.collect())
    if name in ORACLES:
        cur = con.execute(ORACLES[name])
        names = [c[0] for c in cur.description]
        want = sorted(tuple(norm(dict(zip(names, r))[c]) for c in order) for r in cur.fetchall())
        assert got == want
