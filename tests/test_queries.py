"""The registered queries against their SQL at the smallest scale."""

from __future__ import annotations

import os

import pytest

import check
from __spark_entry__ import SMOKE_DIR, entry
from gridtide.plans.oracle import ORACLE
from gridtide.plans.queries import QUERIES

# Many-stage layout queries: their operators have tests of their own, and check.py runs all.
HEAVY = {
    "tidy_time_across", "tidy_no_metadata", "tidy_fallback_mixed", "series_metadata",
    "cube_matrix", "cube_auto_fallback", "footer_and_notes", "discover_files", "api_key",
    "refresh_index", "refresh_releases", "request_to_obs", "cube_provenance",
}
available = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="no test tables here")


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)


@available
def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


@available
@pytest.mark.parametrize("name", sorted(set(QUERIES) - HEAVY))
def test_query(spark, name):
    ok, message = check.compare(spark, check.views(SMOKE_DIR), name, SMOKE_DIR)
    assert ok, message
