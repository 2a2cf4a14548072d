"""Every query with an SQL twin gives the twin's rows; the others give rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from holdfast.plans.catalog import ORACLES, QUERIES
from tests.oracle import compare, connect

# Nothing to find in the smallest data set.
MAY_BE_EMPTY = {"ring_id_conflicts"}
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, sf_dir, name):
    problems = compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name])
    if name in MAY_BE_EMPTY:
        problems = [p for p in problems if p != "no rows"]
    assert not problems


def test_only_known_queries_lack_a_twin():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    rows = contract.entry(spark).collect()
    assert {r.kind for r in rows} == {"HOUR", "DAY", "MONTH"}
