"""Every query against its SQL on the small tables, and the contract of the entry module."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

from .conftest import SMALL

CORE = {k: v for m in ("tapelake.plans.problems", "tapelake.plans.engine", "tapelake.plans.checks", "tapelake.plans.evidence") for k, v in __import__(m, fromlist=["x"]).QUERIES.items()}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in glob.glob(f"{SMALL}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.mark.parametrize("name", sorted(CORE))
def test_query(spark, duck, name):
    df = CORE[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        assert columns
        return
    rel = duck.execute(sql)
    head = [d[0] for d in rel.description]
    assert sorted(head) == columns
    want = sorted((tuple(plain(r[head.index(c)]) for c in columns) for r in rel.fetchall()), key=repr)
    assert got == want


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
