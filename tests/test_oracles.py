"""Every registered query against its SQL twin on the smallest driver tables."""

import math
import os

import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    try:
        number = float(value)
    except TypeError:
        return str(value)
    except ValueError:
        return str(value)
    return None if math.isnan(number) else number


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    found = as_rows(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert found
        return
    twin = duck.sql(sql)
    assert sorted(df.columns) == sorted(twin.columns)
    assert found == as_rows(twin.columns, twin.fetchall())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
