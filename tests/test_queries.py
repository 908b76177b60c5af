"""Every registered query against its SQL on the smallest data set, values and types."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference, entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not there")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(entry.all_queries()) == set(entry.SQL)


@pytest.mark.parametrize("name", list(entry.all_queries()))
def test_query(spark, con, name):
    assert difference(spark, con, name, SF_DIR) == ""


UNDATED = ["sink_report", "ingest_incremental", "ingest_outcomes", "sales_status", "sales_digest"]


@pytest.mark.parametrize("name", UNDATED)
def test_query_with_undated_reports(spark, name):
    """The smallest data set has no undated report of a location in use."""
    folder = SF_DIR.replace("sf0.001", "sf0.01")
    assert difference(spark, connect(folder), name, folder) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
