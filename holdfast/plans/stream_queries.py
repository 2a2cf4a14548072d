"""Registered queries that run a stream to its end and return its final state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.plans.delay_sql import stmt
from holdfast.plans.registry import ORACLES, query
from holdfast.plans.store_queries import _MAP, BLOCK, classified_heartbeats
from holdfast.plans.store_sql import TRAFFIC
from holdfast.session import fresh_path
from holdfast.sources import store_tables as st
from holdfast.streaming import feeds, heartbeats, registration, replica_stream

TIMEOUT = "6 hours"


def _reports(spark: SparkSession, sf: str) -> DataFrame:
    return classified_heartbeats(spark, sf).select(
        "node", "seq", feeds.instant("ts").alias("ts"), "kind", F.col("seq").alias("entry"), "free_space"
    )


def _heartbeat_feed(spark: SparkSession, sf: str, closed: bool) -> DataFrame:
    path = fresh_path(spark, "heartbeats")
    rows = _reports(spark, sf) if not closed else st.heartbeats(spark, sf).select(
        "node", "seq", feeds.instant("ts").alias("ts"), "free_space"
    )
    feeds.write_feed(rows, "seq", path)
    if closed:
        heartbeats.clock_tick(rows, "3 DAYS").write.mode("append").parquet(path)
    return feeds.open_feed(spark, path)


@query("st_heartbeat_fold", stmt(TRAFFIC, """
classed AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY seq) % 10 = 0 AS major FROM hb),
lasts AS (SELECT node, max(seq) FILTER (major) AS last_major FROM classed GROUP BY node)""", body="""
SELECT node, max(seq) AS seq, arg_max(free_space, seq) AS free_space,
  string_agg(CAST(seq AS VARCHAR), '-' ORDER BY seq DESC) FILTER (last_major IS NULL OR seq >= last_major) AS entries
FROM classed JOIN lasts USING (node) GROUP BY node"""))
def st_heartbeat_fold(spark: SparkSession, sf: str) -> DataFrame:
    written = feeds.run_to_end(heartbeats.fold_reports(_heartbeat_feed(spark, sf, closed=False)), "fold")
    last = heartbeats.latest_state(written, "seq", "free_space", "entries")
    return last.withColumn("entries", F.array_join(F.col("entries").cast("array<string>"), "-"))


@query("st_node_latest", stmt(TRAFFIC, body="""
SELECT node, max(seq) AS seq, arg_max(free_space, seq) AS free_space FROM hb GROUP BY node"""))
def st_node_latest(spark: SparkSession, sf: str) -> DataFrame:
    written = feeds.run_to_end(heartbeats.latest_reports(_heartbeat_feed(spark, sf, closed=False)), "latest", updates=True)
    return heartbeats.latest_state(written, "seq", "free_space")


@query("st_liveness_sessions", stmt(TRAFFIC, """
marked AS (
  SELECT node, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY node ORDER BY seq) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS starts FROM hb),
islands AS (SELECT node, ts, sum(starts) OVER (PARTITION BY node ORDER BY ts) AS island FROM marked)""", body="""
SELECT node, min(ts) AS live_from, max(ts) + INTERVAL 6 HOUR AS dead_at, count(*) AS reports FROM islands GROUP BY node, island"""))
def st_liveness_sessions(spark: SparkSession, sf: str) -> DataFrame:
    with heartbeats.sessions_merged_early(spark):
        written = feeds.run_to_end(heartbeats.live_intervals(_heartbeat_feed(spark, sf, closed=True), TIMEOUT), "live")
    return written.select("node", feeds.naive("live_from").alias("live_from"), feeds.naive("dead_at").alias("dead_at"), "reports")


#: Every fiftieth report arrives after all the others.
DELAYED = 50


@query("st_liveness_late", stmt(TRAFFIC, body=f"""
SELECT node, seq, ts FROM hb WHERE seq % {DELAYED} = 0
  AND ts < (SELECT max(ts) FROM hb WHERE seq % {DELAYED} <> 0) - INTERVAL 1 HOUR"""))
def st_liveness_late(spark: SparkSession, sf: str) -> DataFrame:
    """The reports that come too late to count for live intervals, kept in a table of their own."""
    path = fresh_path(spark, "late-feed")
    rows = st.heartbeats(spark, sf).select("node", "seq", feeds.instant("ts").alias("ts"), "free_space")
    end = rows.agg(F.max("seq") + 1).scalar()
    arrival = F.when(F.col("seq") % DELAYED == 0, F.col("seq") + end).otherwise(F.col("seq")).alias("arrival")
    feeds.write_feed(rows.select("*", arrival), "arrival", path, slices=4)
    stream, out = feeds.open_feed(spark, path), fresh_path(spark, "late-out")
    feeds.split_late(stream, "ts", heartbeats.LATENESS, out)
    late = feeds.read_side(spark, f"{out}/late", stream.schema)
    return late.select("node", "seq", feeds.naive("ts").alias("ts"))


@query("st_register_status", ORACLES["dfs_register_status"])
def st_register_status(spark: SparkSession, sf: str) -> DataFrame:
    """Answers of the registration service over several batches."""
    path = fresh_path(spark, "requests")
    feeds.write_feed(st.heartbeats(spark, sf).select("seq", "node"), "seq", path)
    return feeds.run_to_end(registration.register(feeds.open_feed(spark, path)), "registered")


@query("st_replica_map", _MAP)
def st_replica_map(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "replica-events")
    feeds.write_feed(st.replica_events(spark, sf), "seq", path)
    with replica_stream.map_state(spark):
        written = feeds.run_to_end(replica_stream.follow(feeds.open_feed(spark, path), BLOCK), "replicas")
    lists = replica_stream.latest_lists(written)
    return lists.select("chunk", F.array_join(F.col("nodes").cast("array<string>"), "-").alias("nodes"))
