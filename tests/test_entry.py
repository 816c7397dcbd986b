"""The driver contract: all queries run on the smallest tables, and agree with their SQL."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from lumenfolio.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else f"{float(v):.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v.replace(tzinfo=None)) if hasattr(v, "tzinfo") else str(v)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_entry(spark):
    assert entry.entry(spark).columns == ["item_id", "doc_id", "hits_6", "hits_5", "hits_4", "covered", "score", "rank"]
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if sql := entry.oracle_sql().get(name):
        got = duck.execute(sql)
        names = [d[0] for d in got.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        assert rows == sorted(tuple(plain(r[i]) for i in at) for r in got.fetchall())
