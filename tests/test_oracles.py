"""Every query with SQL gives the rows that DuckDB gives."""

from __future__ import annotations

import datetime
import math

import duckdb
import pytest

from civicspark.registry import ORACLES, QUERIES

SF_SMALL = "/root/testdata/sf0.001"

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return tuple(map(plain, value)) if isinstance(value, list) else value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    found = duck.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    order = [columns.index(c) for c in sorted(columns)]
    want = sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in sorted(columns)) for r in df.collect()), key=repr)
    assert got == want


def test_every_query_without_sql_runs(spark):
    for name in sorted(set(QUERIES) - set(ORACLES)):
        assert QUERIES[name](spark, SF_SMALL).collect()
