"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.database(TINY)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_agrees(spark, con, name):
    verdict, _ = compare.compare(spark, con, name, TINY)
    assert verdict.startswith(("ok", "rows-only")) and "TYPES" not in verdict, verdict
