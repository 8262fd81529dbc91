"""Every registered query against its SQL, on the smallest driver tables."""

from __future__ import annotations

import os

import pytest

from harness.registry import spark_queries, sql_queries
from harness.verify import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(spark_queries()) == set(sql_queries())


@pytest.mark.parametrize("name", sorted(spark_queries()))
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, name, SF_DIR) == ""
