"""Every query of the engine's own operators against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from kinfold.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=str)
    if name not in registry.ORACLES:
        return
    cur = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall()), key=str)
    assert rows == want
