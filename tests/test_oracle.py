"""Every registered query against its SQL oracle."""

import os

import duckdb
import pytest
from compare import differences
from shops import CUT, LAST, random_rows

import __spark_entry__ as entry
from conformance.oracle import oracle_sql
from conformance.queries import SHOP_QUERIES

SF_DIR = os.environ.get("TIDEMARK_SF_DIR", "/root/testdata/sf0.001")
STAR = ["region", "nation", "customer", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def star():
    connection = duckdb.connect()
    for table in STAR:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def made(spark):
    rows = random_rows(seed=7)
    shop = rows.to_shop(spark)
    return shop, rows.to_duckdb(shop)


def test_every_query_has_an_oracle():
    assert set(SHOP_QUERIES) <= set(entry.queries()) & set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SHOP_QUERIES))
def test_star_tables(spark, star, name):
    result = entry.queries()[name](spark, SF_DIR)
    assert differences(result, star.execute(entry.oracle_sql()[name])) is None


@pytest.mark.parametrize("name", sorted(n for n in SHOP_QUERIES if not n.startswith("s_")))
def test_made_tables(spark, made, name):
    shop, connection = made
    result = SHOP_QUERIES[name](spark, shop, CUT, LAST)
    expected = connection.execute(oracle_sql(CUT, LAST, adapter=False)[name])
    assert differences(result, expected) is None


def test_entry_has_the_whole_matrix(spark):
    matrix = entry.entry(spark)
    assert len(matrix.columns) == 98
