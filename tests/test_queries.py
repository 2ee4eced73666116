"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as registered
from histora.catalog.queries import QUERIES
from tests.compare import difference, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(registered.queries()) and set(QUERIES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    assert difference(con, registered.queries()[name](spark, FOLDER), registered.oracle_sql()[name]) is None


def test_entry(spark):
    assert registered.entry(spark).count() > 0
