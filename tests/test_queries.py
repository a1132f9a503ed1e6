"""Every registered query of the counter operators against its SQL, on the smallest tables."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

from countflow import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in sorted(os.listdir(SF)):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if math.isnan(v) else float(f"{float(v):.8g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    want = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL) - {"q14_forecast_scores", "q15_neighbour_gain"}))
def test_query_without_sql_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_flagship_is_registered():
    assert catalog.FLAGSHIP in catalog.QUERIES and set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)
