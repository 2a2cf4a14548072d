"""Plans of the training-data queries: nothing is paired with everything, nothing is an RDD."""

from __future__ import annotations

import re

import pytest

from holdfast.llm.catalog import ORACLES, QUERIES
from tests.oracle import compare, connect
from tests.test_plans import plan


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if re.match(r"op\d+_", n)))
def test_no_query_pairs_everything_with_everything(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not any(bad in text for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert not compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])


def test_no_operator_runs_in_python_where_it_should_not(spark, sf_dir):
    for name in ("op6_shard_shuffle", "op9_decontamination"):
        assert not any(x in plan(QUERIES[name](spark, sf_dir)) for x in ("Python", "Arrow", "Pandas"))
