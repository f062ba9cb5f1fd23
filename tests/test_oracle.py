"""Every query against its checking SQL on the driver's smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from compare import connect, difference
from sheetloom.plans import load_registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


REGISTRY = load_registry()


@pytest.mark.parametrize("name", sorted(REGISTRY.RUNS))
def test_query(spark, con, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    assert difference(df, con, entry_points.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_a_check():
    assert set(REGISTRY.RUNS) == set(REGISTRY.CHECKS)
    assert set(REGISTRY.RUNS) <= set(entry_points.queries())
