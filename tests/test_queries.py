"""Every registered query runs at sf0.001 and equals its SQL twin."""

import importlib
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tests.oracle import compare, database  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
entry = importlib.import_module("__spark_entry__")
QUERIES, TWINS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_twins_belong_to_queries():
    assert set(TWINS) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, message = compare(con, spark, SF_DIR, QUERIES[name], TWINS.get(name))
    assert ok, message
