"""The numbered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from quarrymill.llm.queries import QUERIES
from quarrymill.llm.sql import ORACLE_SQL
from tests.test_queries import SF, TABLES, counted

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    rows, order = [tuple(r) for r in df.collect()], sorted(df.columns)
    assert rows
    if name in ORACLE_SQL:
        duck = duckdb.connect()
        for t in TABLES:
            duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        cur = duck.execute(ORACLE_SQL[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == order
        assert counted(rows, [df.columns.index(c) for c in order]) == counted(cur.fetchall(), [names.index(c) for c in order])
