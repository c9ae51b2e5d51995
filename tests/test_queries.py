"""Every registered query against its SQL, at the smallest scale."""

import os

import pytest

import __spark_entry__ as contract
import check

FOLDER = os.environ.get("TAMIZ_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    return check.connection(FOLDER)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_equals_sql(spark, db, name):
    df = contract.queries()[name](spark, FOLDER)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert check.difference(df, db, sql) == ""


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
