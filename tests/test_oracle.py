"""Every registered query against its DuckDB oracle on sf0.001 (rows,
column names and an order-insensitive hash of the values)."""

import os

import duckdb
import pytest
from conftest import SF001

from __spark_entry__ import entry
from tagloom.plans.oracle import oracle_sql
from tagloom.plans.queries import QUERIES
from tools.oracle_check import value_hash

TABLES = ("supplier", "part", "orders", "lineitem")
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    # same column types as DuckDB reports for the oracle
    spark_types = {f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {oracle_sql()[name]}").fetchall()}
    assert spark_types == duck_types
    assert len(srows) == len(orows)
    assert value_hash(df.columns, srows) == value_hash(ocols, orows)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["technode1", "technode2", "name", "weight", "cnt"]
    assert df.count() == 1550


def test_fixtures_present():
    assert os.path.exists(f"{SF001}/lineitem.parquet")
