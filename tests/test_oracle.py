"""Every registered query against its oracle SQL, on the smallest tables."""

from __future__ import annotations

import compare
import pytest
from conftest import SF_DIR

from skyledger.checks import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    verdict, detail = compare.compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES.get(name))
    assert verdict == "ok", detail


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert QUERIES.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()
