"""Every registered query against its SQL on the small tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, compare

SLOW = {"recommendation_size", "similarity_size"}  # same plans as the queries they count


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - SLOW))
def test_query(spark, con, sf_dir, name):
    actual = contract.queries()[name](spark, sf_dir).toPandas()
    assert len(actual.columns)
    if name in contract.oracle_sql():
        assert compare(actual, con.execute(contract.oracle_sql()[name]).df()) == ""


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 1
