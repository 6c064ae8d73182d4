"""Every registered query of the engine against its SQL in DuckDB, on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    return str(v)[:26] if isinstance(v, datetime.datetime) else v


def canonical(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def names():
    from placeforge.plans import registry

    return sorted(registry.queries())


@pytest.mark.parametrize("name", names())
def test_query_matches_sql(spark, duck, name):
    from placeforge.plans import registry

    df = registry.queries()[name](spark, DATA)
    rows = df.collect()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    expected = duck.sql(sql)
    assert sorted(df.columns) == sorted(expected.columns)
    assert canonical(df.columns, rows) == canonical(expected.columns, expected.fetchall())


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
