"""Every registered query against its oracle at the smallest scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from conftest import SF_DIR
from tools.check_queries import compare, connect

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# the optional operators have tests of their own
NAMES = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))


def test_every_query_has_an_oracle():
    assert set(NAMES) == set(entry.oracle_sql()) - set(entry.LLM_ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, con, name):
    good, note = compare(spark, con, name, SF_DIR)
    assert good, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
