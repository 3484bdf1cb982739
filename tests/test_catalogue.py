"""Every registered query against its SQL, and the shape of the registry."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry_module
from rostersync.catalogue.queries import REGISTRY
from rostersync.sources.schemas import MART_COLUMNS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, duck, name):
    query, sql = REGISTRY[name]
    assert sql is not None
    assert compare(query(spark, SF_DIR), duck, sql) == []


def test_entry_returns_the_mart(spark):
    df = entry_module.entry(spark)
    assert tuple(df.columns) == MART_COLUMNS
    assert df.count() > 0


def test_queries_and_oracles_pair_up():
    assert set(REGISTRY) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())
