"""Plans keep the shape they are meant to have."""

from __future__ import annotations

import re

import pytest

from holdfast.plans.catalog import QUERIES
from holdfast.streaming import heartbeats, registration, replica_stream

DELAY = [n for n in QUERIES if re.match(r"(q0|flt_|prj_|join_|dim_|prof_)", n)]


def plan(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", DELAY)
def test_delay_queries_stay_in_the_jvm(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_everything_with_everything(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_scan_reads_only_what_the_flagship_needs(spark, sf_dir):
    text = plan(QUERIES["q01_ranked"](spark, sf_dir))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "l_comment" not in schema and "l_extendedprice" not in schema and "l_suppkey" not in schema
    assert text.count("Location: ") == 1


def test_aggregates_reduce_before_the_shuffle(spark, sf_dir):
    for name in ("q01_mean_delay", "q03_year_airport_counts", "q04_weather_by_airport", "q05_carrier_delay", "q06_coast_airports"):
        assert "partial_" in plan(QUERIES[name](spark, sf_dir)), name


def test_top_ten_never_sorts_everything(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["q04_top10_weather"](spark, sf_dir))
    assert "WindowGroupLimit" in plan(QUERIES["q03_top10_per_year"](spark, sf_dir))


def test_streams_join_nothing_and_reduce_before_their_state(spark):
    """The streaming plans themselves, not only the tables they end in."""
    feed = spark.readStream.format("rate").load()
    events = feed.selectExpr("value AS seq", "'store' AS kind", "value AS chunk", "ARRAY(value) AS nodes")
    reports = feed.selectExpr("value AS node", "value AS seq", "'minor' AS kind", "value AS entry", "value AS free_space")
    analysed = lambda df: df._jdf.queryExecution().analyzed().toString()
    for text in (analysed(replica_stream.follow(events)), analysed(heartbeats.fold_reports(reports)), analysed(registration.register(reports))):
        assert "Join" not in text and "MapInArrow" in text
    assert analysed(replica_stream.follow(events)).index("FlatMapGroupsInPandasWithState") < analysed(replica_stream.follow(events)).index("TransformWithState")
