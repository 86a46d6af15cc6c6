"""Every query against its SQL in a second engine, to the last digit."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from parity.check import connect, difference
from parity.queries import ORACLES
from uptake import schemas
from uptake.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def second_engine():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, second_engine, name):
    assert difference(queries()[name](spark, FOLDER), second_engine, oracle_sql()[name]) is None


def test_differences_are_seen(spark, second_engine):
    df = queries()["mart_customer_sku_month"](spark, FOLDER)
    sql = oracle_sql()["mart_customer_sku_month"]
    assert "schema" in difference(df.drop("lur"), second_engine, sql)
    assert "rows" in difference(df.limit(5), second_engine, sql)
    other = oracle_sql()["overage_cap_60"]
    assert "differ" in difference(df, second_engine, other)


def test_entry(spark, second_engine):
    df = entry(spark)
    assert df.schema.names == schemas.SKU_MONTH.names
    sql = oracle_sql()["mart_customer_sku_month"]
    assert (df.count(),) == second_engine.execute(f"SELECT count(*) FROM ({sql})").fetchone()
