"""Every registered query against its SQL, on the smallest given tables."""

import math
import os
from datetime import date, datetime

import duckdb
import pytest

from fundpanel.catalog import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, datetime):
        return v.date()
    if isinstance(v, float) and math.isnan(v):
        return None
    return v if v is None or isinstance(v, (str, bool, int, date)) else float(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert name in SQL
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    answer = duck.execute(SQL[name])
    types = {d[0]: str(d[1]) for d in answer.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    order = [list(types).index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in order) for r in answer.fetchall()), key=repr)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    assert got == want
