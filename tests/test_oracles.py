"""Every registered query that has SQL gives the rows its SQL gives, on the smallest given folder."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, connect
from vaultline.starbank import oracle, registry

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_bank_query_has_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, connection, name):
    fault = compare(spark, connection, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert fault is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
