"""Every query against its SQL on the smallest tables, and the catalog's shape."""

import math
import os
from collections import Counter

import duckdb
import pytest

from quarrymill import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v if isinstance(v, bool) else str(v)


def counted(rows, order):
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in catalog.ORACLE_SQL:
        assert df.columns
        return
    cur = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(df.columns)
    assert counted(rows, [df.columns.index(c) for c in order]) == counted(cur.fetchall(), [names.index(c) for c in order])


def test_sql_is_for_queries():
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)
