"""Every catalogue query on the smallest test tables, against DuckDB where it has an oracle."""

import datetime
import decimal
import os

import duckdb
import pytest

from lexspark import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for n in TABLES:
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM '{SF}/{n}.parquet'")
    return con


def _plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 5)
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted(repr([_plain(r[c]) for c in cols]) for r in df.collect())
    if name not in plans.ORACLES:
        assert rows
        return
    rel = duck.sql(plans.ORACLES[name])
    names = list(rel.columns)
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert rows == sorted(repr([_plain(r[k]) for k in at]) for r in rel.fetchall())
