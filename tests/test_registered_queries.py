"""Every registered query against its SQL, as the driver does it."""

import os

import pytest
from oracle_compare import differences, open_duckdb

import __spark_entry__ as registry

FOLDER = os.environ.get("TILLWORK_TEST_DATA", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    return open_duckdb(FOLDER)


def test_every_query_has_its_sql():
    assert set(registry._QUERIES) <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    found = registry.queries()[name](spark, FOLDER)
    assert differences(found, duck, registry.oracle_sql()[name]) is None


def test_entry(spark):
    assert registry.entry(spark).count() > 0
