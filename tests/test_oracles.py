"""Every query with an oracle gives the same rows as its SQL in DuckDB."""

import datetime
import decimal
import os

import duckdb
import pytest

from metrolith.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, datetime.datetime):
        return v.isoformat() if v.time() != datetime.time(0) else v.date().isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in values)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    found = catalog.QUERIES[name](spark, SF)
    answer = duck.execute(catalog.ORACLES[name])
    names = [c[0] for c in answer.description]
    assert sorted(found.columns) == sorted(names)
    assert rows(found.columns, [tuple(r) for r in found.collect()]) == rows(names, answer.fetchall())
