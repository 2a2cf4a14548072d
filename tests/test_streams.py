"""Streams end in the state their batch twins compute, however the input is cut."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from holdfast.operators import replica_lists
from holdfast.session import fresh_path
from holdfast.operators import running
from holdfast.streaming import feeds, heartbeats, registration, replica_stream


def beats(spark, rows):
    start = datetime(2024, 1, 1)
    data = [(node, seq, start + timedelta(minutes=m), kind, seq, free) for seq, (node, m, kind, free) in enumerate(rows)]
    return spark.createDataFrame(data, "node bigint, seq bigint, ts timestamp_ntz, kind string, entry bigint, free_space bigint").withColumn(
        "ts", feeds.instant("ts"))


def feed(spark, rows, slices):
    path = fresh_path(spark, "feed")
    feeds.write_feed(rows, "seq", path, slices)
    return feeds.open_feed(spark, path, files_per_batch=1)


@pytest.mark.parametrize("slices", [1, 3])
def test_fold_restarts_at_major_reports(spark, slices):
    rows = beats(spark, [(1, 0, "minor", 10), (2, 1, "major", 20), (1, 2, "major", 11), (1, 3, "minor", 12), (2, 4, "minor", 21)])
    written = feeds.run_to_end(heartbeats.fold_reports(feed(spark, rows, slices)), "fold")
    got = heartbeats.latest_state(written, "seq", "free_space", "entries").collect()
    assert {r.node: (r.seq, r.free_space, r.entries) for r in got} == {1: (3, 12, [3, 2]), 2: (4, 21, [4, 1])}


@pytest.mark.parametrize("shares", [1, 3])
def test_nodes_of_a_share_are_folded_together(spark, shares):
    """One call of the fold for a share and batch, however many nodes it has; only the nodes of the batch are sent."""
    rng = random.Random(shares)
    data = [(rng.randrange(40), s, rng.choice(["major", "minor", "minor"]), rng.randrange(1000)) for s in range(600)] + [(99, 600, "minor", 5)]
    rows = beats(spark, [(n, m, k, f) for n, m, k, f in data])
    written = feeds.run_to_end(heartbeats.fold_reports(feed(spark, rows, 4), shares), "fold")
    want = {}
    for node, seq, kind, free in data:
        want[node] = (seq, free, [seq, *([] if kind == "major" else want[node][2] if node in want else [])])
    got = heartbeats.latest_state(written, "seq", "free_space", "entries").collect()
    assert {r.node: (r.seq, r.free_space, r.entries) for r in got} == want
    assert written.where("node = 99").count() == 1 and written.groupBy("node", "seq").count().where("count > 1").count() == 0


class _Held:
    """The map state of a node, for its processor alone."""

    def __init__(self):
        self.kept = {}

    def keys(self):
        return iter(list(self.kept))

    def clear(self):
        self.kept.clear()

    def updateValue(self, key, value):
        self.kept[key] = value


def test_all_deaths_of_a_batch_are_one_table():
    deaths = replica_stream._Deaths()
    deaths.held = _Held()
    none = float("nan")
    first = pd.DataFrame({"seq": range(1, 9), "chunk": [4, 4, none, none, 5, 4, none, 6]})
    out = list(deaths.handleInputRows((3,), iter([first[4:], first[:4]]), None))
    assert len(out) == 1 and sorted(map(tuple, out[0].to_numpy().tolist())) == [(4, 3, 3), (4, 7, 3), (5, 7, 3)]
    assert list(deaths.held.kept) == [(6,)]
    out = list(deaths.handleInputRows((3,), iter([pd.DataFrame({"seq": [9, 10], "chunk": [none, none]})]), None))
    assert [tuple(r) for t in out for r in t.to_numpy().tolist()] == [(6, 9, 3)] and not deaths.held.kept


def test_liveness_intervals_close_after_the_timeout(spark):
    rows = beats(spark, [(1, 0, "minor", 1), (1, 20, "minor", 1), (2, 30, "minor", 1), (1, 120, "minor", 1)])
    path = fresh_path(spark, "feed")
    feeds.write_feed(rows, "seq", path, 2)
    heartbeats.clock_tick(rows, "1 DAY").write.mode("append").parquet(path)
    with heartbeats.sessions_merged_early(spark):
        written = feeds.run_to_end(heartbeats.live_intervals(feeds.open_feed(spark, path, 1), "30 minutes"), "live")
    start = datetime(2024, 1, 1)
    got = {(r.node, r.f, r.d, r.reports) for r in written.select(
        "node", feeds.naive("live_from").alias("f"), feeds.naive("dead_at").alias("d"), "reports").collect()}
    at = lambda m: start + timedelta(minutes=m)
    assert got == {(1, at(0), at(50), 2), (2, at(30), at(60), 1), (1, at(120), at(150), 1)}


def test_a_late_report_is_the_current_one(spark):
    rows = beats(spark, [(1, 1000, "minor", 5), (2, 1001, "minor", 5), (1, 0, "minor", 9)])
    path = fresh_path(spark, "feed")
    feeds.write_feed(rows, "seq", path, 3)
    written = feeds.run_to_end(heartbeats.latest_reports(feeds.open_feed(spark, path, 1)), "latest", updates=True)
    got = {(r.node, r.free_space) for r in heartbeats.latest_state(written, "seq", "free_space").collect()}
    assert got == {(1, 9), (2, 5)}


@pytest.mark.parametrize("slices", [1, 4])
def test_replica_stream_equals_batch(spark, slices):
    kinds = ["store", "corrupt", "fixed", "deleted"]
    rows = [(s, kinds[(s * 7 + s // 5) % 4], s % 3, [(s + i) % 5 for i in range(3)] if (s * 7 + s // 5) % 4 == 0 else [s % 5]) for s in range(120)]
    df = spark.createDataFrame(rows, "seq bigint, kind string, chunk bigint, nodes array<bigint>")
    with replica_stream.map_state(spark):
        written = feeds.run_to_end(replica_stream.follow(feed(spark, df, slices)), "replicas")
    streamed = {r.chunk: r.nodes for r in replica_stream.latest_lists(written).collect()}
    assert streamed == {r.chunk: r.nodes for r in replica_lists.replica_map(df, 16).collect()}


@pytest.mark.parametrize(("slices", "block", "shares"), [(1, 1_000_000, 1), (4, 16, 3), (5, 5, 2)])
def test_deaths_are_spread_inside_the_stream(spark, slices, block, shares):
    rng = random.Random(slices)
    rows = []
    for seq in range(240):
        kind = rng.choice(["store", "corrupt", "fixed", "deleted", "dead"])
        rows.append((seq, kind, None if kind == "dead" else rng.choice([0, 0, 1, 2]), rng.sample(range(6), 3) if kind == "store" else [rng.randrange(6)]))
    df = spark.createDataFrame(rows, "seq bigint, kind string, chunk bigint, nodes array<bigint>")
    with replica_stream.map_state(spark):
        written = feeds.run_to_end(replica_stream.follow(feed(spark, df, slices), block, shares), "replicas")
    streamed = {r.chunk: r.nodes for r in replica_stream.latest_lists(written).collect()}
    assert streamed == {r.chunk: r.nodes for r in replica_lists.replica_map(df, 16).collect()}


def test_a_feed_is_read_slice_by_slice(spark):
    rows = spark.range(1000).selectExpr("(id * 37) % 1000 AS seq").repartition(8)
    path = fresh_path(spark, "feed")
    feeds.write_feed(rows, "seq", path, 5)
    seen = []
    running_ = feeds.open_feed(spark, path, 1).writeStream.foreachBatch(
        lambda df, _: seen.append((df.count(), *df.selectExpr("min(seq)", "max(seq)").first()))).option(
        "checkpointLocation", fresh_path(spark, "state")).trigger(availableNow=True).start()
    running_.awaitTermination()
    assert seen == [(200, 200 * i, 200 * i + 199) for i in range(5)]


def test_a_node_sends_one_row_a_task(spark):
    rows = spark.range(9000).selectExpr("id % 3 AS node", "id AS seq", "IF(id % 30 = 0, 'major', 'minor') AS kind", "id AS entry", "id AS free_space").repartition(4)
    reduced = heartbeats.reduce_reports(rows)
    counts = reduced.groupBy("node").count().collect()
    assert {r["count"] for r in counts} == {4}
    merged = {}
    for r in sorted(reduced.collect(), key=lambda r: r.free_space * 7 % 11):  # in any order
        part = (r.restart, r.seqs, r.entries, r.free_space)
        merged[r.node] = heartbeats.merge_summaries([merged[r.node], part] if r.node in merged else [part])
    for node, (restart, seqs, entries, free) in merged.items():
        last = max((s for s in range(node, 9000, 3) if s % 30 == 0), default=-1)
        assert restart == last and seqs == entries == [s for s in range(8997 + node, -1, -3) if s >= last] and free == 8997 + node


def test_late_reports_are_kept_apart(spark):
    rows = beats(spark, [(1, 0, "minor", 1), (1, 100, "minor", 1), (2, 200, "minor", 1), (1, 139, "minor", 1), (2, 141, "minor", 1), (1, 300, "minor", 1), (3, 250, "minor", 1), (3, 0, "minor", 1)])
    path, out = fresh_path(spark, "feed"), fresh_path(spark, "split")
    feeds.write_feed(rows, "seq", path, 4)
    stream = feeds.open_feed(spark, path, 1)
    feeds.split_late(stream, "ts", "1 hour", out)
    late = {r.seq for r in feeds.read_side(spark, f"{out}/late", stream.schema).collect()}
    kept = {r.seq for r in feeds.read_side(spark, f"{out}/on-time", stream.schema).collect()}
    # batches of two rows: (0, 100), (200, 139), (141, 300), (250, 0)
    assert late == {7} and kept == set(range(7))
    feeds.split_late(feeds.open_feed(spark, path, 1), "ts", "1 minute", other := fresh_path(spark, "split"))
    assert {r.seq for r in feeds.read_side(spark, f"{other}/late", stream.schema).collect()} == {4, 6, 7}
    assert feeds.read_side(spark, f"{other}/nothing", stream.schema).count() == 0


def test_on_time_reports_all_count(spark):
    """Live intervals over the on-time side hold every row of it."""
    rows = beats(spark, [(s % 3, (s * 13) % 90 + s, "minor", 1) for s in range(60)])
    path, out = fresh_path(spark, "feed"), fresh_path(spark, "split")
    feeds.write_feed(rows, "seq", path, 5)
    stream = feeds.open_feed(spark, path, 1)
    feeds.split_late(stream, "ts", "20 minutes", out)
    kept = feeds.read_side(spark, f"{out}/on-time", stream.schema)
    heartbeats.clock_tick(kept, "1 DAY").select(*stream.columns).write.parquet(f"{out}/on-time/batch=9")
    side = spark.readStream.schema(stream.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{out}/on-time")
    written = feeds.run_to_end(heartbeats.live_intervals(side, "30 minutes", "20 minutes"), "live")
    assert written.where("node is null").count() == 0
    total = sum(r.reports for r in written.collect())
    assert total == kept.where("node is not null").count() and 0 < feeds.read_side(spark, f"{out}/late", stream.schema).count()


@pytest.mark.parametrize("slices", [1, 4])
def test_registration_stream_equals_batch(spark, slices):
    rng = random.Random(slices)
    rows = spark.createDataFrame([(s, rng.choice([7, 7, 7, 1, 2, 3, 4])) for s in rng.sample(range(1000), 300)], "seq bigint, node bigint").repartition(3)
    streamed = feeds.run_to_end(registration.register(feed(spark, rows, slices)), "registered")
    want = {(r.seq, r.node, r.status) for r in running.first_per_key(rows, "node", "seq").collect()}
    assert sorted(tuple(r) for r in streamed.collect()) == sorted(want)


def test_one_task_settles_all_but_one_request_of_a_node(spark):
    rows = spark.range(1, 5000).selectExpr("id % 5 AS node", "5000 - id AS seq").coalesce(1)
    marked = rows.mapInArrow(registration._mark, registration._MARKED)
    assert {(r.node, r.seq) for r in marked.where("candidate").collect()} == {(n, min(5000 - i for i in range(1, 5000) if i % 5 == n)) for n in range(5)}
    assert marked.count() == 4999


def test_splitting_goes_on_where_it_stopped(spark):
    rows = beats(spark, [(1, 0, "minor", 1), (1, 500, "minor", 1)])
    path, out = fresh_path(spark, "feed"), fresh_path(spark, "split")
    feeds.write_feed(rows, "seq", path, 2)
    stream = feeds.open_feed(spark, path, 1)
    feeds.split_late(stream, "ts", "1 hour", out)
    more = beats(spark, [(0, 0, "minor", 1), (0, 0, "minor", 1), (2, 100, "minor", 1), (2, 450, "minor", 1)]).where("seq > 1")
    more.coalesce(1).write.mode("append").parquet(path)
    feeds.split_late(feeds.open_feed(spark, path, 1), "ts", "1 hour", out)
    late, kept = ({r.seq for r in feeds.read_side(spark, f"{out}/{side}", stream.schema).collect()} for side in ("late", "on-time"))
    assert late == {2} and kept == {0, 1, 3}
