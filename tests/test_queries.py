"""Every registered query beside its SQL."""

import pytest
from helpers import DATA
from oracle import compare, connect

import __spark_entry__ as contract
from tablesync.plans.queries import QUERIES
from tablesync.plans.queries.registry import MAKERS

SF_DIR = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    assert name in contract.queries() and name in contract.oracle_sql()
    assert compare(spark, con, name, SF_DIR) == []


@pytest.mark.parametrize("name", sorted(MAKERS))
def test_maker_matches_its_sql(spark, con, name):
    assert name not in contract.queries()
    assert compare(spark, con, name, SF_DIR) == []


def test_entry_gives_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
