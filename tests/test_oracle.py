"""Every registered query against its SQL twin, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from callsift.plans import oracle
from callsift.plans.queries import REGISTRY

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(REGISTRY)
    assert set(REGISTRY) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, small, duck, name):
    df = REGISTRY[name](spark, small)
    relation = duck.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert {c: SPARK_TO_SQL[t] for c, t in df.dtypes} == types
    place = [relation.columns.index(c) for c in columns]
    expected = [tuple(row[i] for i in place) for row in relation.fetchall()]
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    assert len(got) > 0
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0
