"""Running values, placement and replica lists against brute force, with many small blocks."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs

from holdfast.operators import placement, replica_lists, running


def test_row_numbers_and_upserts(spark):
    rng = random.Random(1)
    rows = [(s, rng.choice([0, 0, 0, 1, 2]), rng.randrange(40)) for s in range(400)]
    df = spark.createDataFrame(rows, "seq bigint, key bigint, v bigint")
    turns, best, versions, want_turn, want = {}, {}, {}, {}, {}
    for s, k, v in rows:
        turns[k] = turns.get(k, 0) + 1
        want_turn[s] = turns[k]
        accepted = k not in best or v > best[k]
        if accepted:
            best[k], versions[k] = v, versions.get(k, 0) + 1
        want[s] = (accepted, versions[k])
    assert {r.seq: r.turn for r in running.number_rows(df, "key", "seq", "turn", 16).collect()} == want_turn
    got = running.newer_only(df, "key", "seq", "v", 16).collect()
    assert {r.seq: (r.accepted, r.version) for r in got} == want
    last = running.latest_version(df, "key", "seq", "v", 16).collect()
    assert {r.key: (r.version, r.v) for r in last} == {k: (versions[k], best[k]) for k in best}


def test_equal_and_older_writes_are_ignored(spark):
    df = spark.createDataFrame([(0, 1, 10), (1, 1, 10), (2, 1, 9), (3, 1, 11)], "seq bigint, key bigint, v bigint")
    got = running.newer_only(df, "key", "seq", "v", 1).orderBy("seq").collect()
    assert [(r.accepted, r.version) for r in got] == [(True, 1), (False, 1), (False, 1), (True, 2)]


def test_only_the_first_registration_counts(spark):
    df = spark.createDataFrame([(4, "a"), (2, "a"), (3, "b")], "seq bigint, node string")
    assert {r.seq: r.status for r in running.first_per_key(df, "node", "seq").collect()} == {4: 0, 2: 1, 3: 1}


@pytest.mark.parametrize("block", [7, 64, 10_000])
def test_placement(spark, block):
    rng = random.Random(block)
    reports, requests, want, known = [], [], [], {}
    for seq in range(300):
        if rng.random() < 0.3:
            requests.append((seq,))
            best = sorted(known, key=lambda n: (-known[n], n))[:3]
            if len(best) == 3:
                want += [(seq, rank + 1, n) for rank, n in enumerate(best)]
        else:
            node, free = rng.randrange(8), rng.randrange(5)
            known[node] = free
            reports.append((seq, node, free))
    hb = spark.createDataFrame(reports, "seq bigint, node bigint, free_space bigint")
    req = spark.createDataFrame(requests, "seq bigint")
    got = placement.place(req, hb, 3, block).collect()
    assert sorted((r.seq, r["rank"], r.node) for r in got) == sorted(want)
    rejected = {r.seq for r in placement.place_rejections(req, hb, 3).collect() if r.status == "rejected"}
    assert rejected == {s for (s,) in requests} - {s for s, _, _ in want}


def test_too_few_nodes_reject_everything(spark):
    hb = spark.createDataFrame([(0, 1, 5), (1, 2, 5)], "seq bigint, node bigint, free_space bigint")
    req = spark.createDataFrame([(2,), (9,)], "seq bigint")
    assert placement.place(req, hb, 3).count() == 0
    assert {r.status for r in placement.place_rejections(req, hb, 3).collect()} == {"rejected"}


def test_idle_nodes_are_carried_over_few_spans(spark):
    nodes, blocks, k = 300, 500, 3
    reports = [(n, n, n % 17) for n in range(nodes)] + [(2_000 + 7 * i, i % 5, i % 23) for i in range(200)]
    asked = [(nodes + 11 * i,) for i in range(300)]
    known, want = {}, []
    for seq, node, free in sorted([*reports, *[(s, None, None) for s, in asked if s not in {r[0] for r in reports}]]):
        if node is not None:
            known[node] = free
            continue
        want += [(seq, rank + 1, n) for rank, n in enumerate(sorted(known, key=lambda n: (-known[n], n))[:k])]
    taken = {r[0] for r in reports}
    req = spark.createDataFrame([a for a in asked if a[0] not in taken], "seq bigint")
    hb = spark.createDataFrame(reports, "seq bigint, node bigint, free_space bigint")
    assert {tuple(r) for r in placement.place(req, hb, k, 7).collect()} == set(want)
    held = spark.createDataFrame([(n % 5, blocks - n % 3) for n in range(nodes)], "lo bigint, hi bigint")
    assert placement.quiet_spans(held).count() <= nodes * 2 * blocks.bit_length()


def test_spans_cover_a_range_once(spark):
    held = spark.createDataFrame([(a * 100 + b, a, b) for a in range(20) for b in range(a, 40)], "id bigint, lo bigint, hi bigint")
    covered = {}
    for r in placement.quiet_spans(held).collect():
        covered.setdefault(r.id, []).extend(range(r.span << r.level, (r.span + 1) << r.level))
    assert {i: sorted(c) for i, c in covered.items()} == {a * 100 + b: list(range(a, b + 1)) for a in range(20) for b in range(a, 40)}


def test_rereplication(spark):
    replicas = spark.createDataFrame(
        [("f", 0, 0, 1), ("f", 0, 1, 2), ("f", 0, 2, 3), ("g", 0, 0, 1), ("h", 0, 0, 2), ("h", 0, 1, 1)],
        "filename string, chunk_no bigint, rank bigint, node bigint")
    nodes = spark.createDataFrame([(1, 99), (2, 80), (3, 70), (4, 60), (5, 60)], "node bigint, free_space bigint")
    dead = spark.createDataFrame([(1,)], "node bigint")
    got = {(r.filename, r.dead_node, r.donor, r.target) for r in placement.rereplicate(replicas, nodes, dead).collect()}
    assert got == {("f", 1, 2, 4), ("h", 1, 2, 3)}
    few = nodes.where("node <= 3")
    got = {(r.filename, r.target) for r in placement.rereplicate(replicas, few, dead).collect()}
    assert got == {("h", 3)}


def brute(events, listed=()):
    listed = list(listed)
    for _, kind, nodes in events:
        if kind == "store":
            listed = list(nodes)
        elif kind == "fixed":
            listed += [n for n in nodes if n not in listed]
        else:
            listed = [n for n in listed if n != nodes[0]]
            if kind == "deleted" and listed:
                listed.append(nodes[0])
    return listed


EVENT = hs.one_of(
    hs.tuples(hs.just("store"), hs.lists(hs.integers(0, 5), min_size=1, max_size=3, unique=True)),
    hs.tuples(hs.sampled_from(["corrupt", "fixed", "deleted", "dead"]), hs.lists(hs.integers(0, 5), min_size=1, max_size=1)),
)


@settings(max_examples=400, deadline=None)
@given(hs.lists(hs.lists(EVENT, max_size=8), max_size=6))
def test_runs_can_be_summarised_apart_and_applied_in_order(runs):
    listed, seq, history = {}, 0, []
    for run in runs:
        numbered = [(seq + i, kind, nodes) for i, (kind, nodes) in enumerate(run)]
        seq += len(run)
        history += numbered
        packed = replica_lists._pack(replica_lists.summarise(numbered))
        row = type("Row", (), packed)
        listed = replica_lists.apply(listed, replica_lists._unpack(row))
    assert replica_lists.ordered(listed) == brute(history)


def bracketings(runs):
    """The composed run for every way to set brackets."""
    if len(runs) == 1:
        return [runs[0]]
    return [replica_lists.compose(a, b) for i in range(1, len(runs)) for a in bracketings(runs[:i]) for b in bracketings(runs[i:])]


@settings(max_examples=300, deadline=None)
@given(hs.lists(hs.integers(0, 6), max_size=4, unique=True), hs.lists(hs.lists(EVENT, max_size=5), min_size=1, max_size=5))
def test_runs_compose_in_every_bracketing(before, runs):
    listed = {node: (-1, at) for at, node in enumerate(before)}
    seq, history, parts = 0, [], []
    for run in runs:
        numbered = [(seq + i, kind, nodes) for i, (kind, nodes) in enumerate(run)]
        seq += len(run)
        history += numbered
        parts.append(replica_lists.summarise(numbered))
    for whole in bracketings(parts):
        assert replica_lists.ordered(replica_lists.apply(listed, whole)) == brute(history, before)


def test_a_run_over_many_nodes_stays_linear():
    """A million events over a hundred thousand nodes, without any ``store`` to start from."""
    rng = random.Random(9)
    kinds = ["corrupt", "fixed", "deleted", "dead"]
    events = [(seq, rng.choice(kinds), [rng.randrange(100_000)]) for seq in range(1_000_000)]
    parts = [replica_lists.summarise(events[i:i + 250_000]) for i in range(0, len(events), 250_000)]
    whole = replica_lists.compose(replica_lists.compose(parts[0], parts[1]), replica_lists.compose(parts[2], parts[3]))
    assert len(replica_lists._pack(whole)["body"]) <= 100_000 * 5 * 8
    listed: dict = {node: (-1, node) for node in range(0, 100_000, 7)}
    want = dict(listed)
    for seq, kind, (node,) in events:
        if kind == "fixed":
            want.setdefault(node, (seq, 0))
        else:
            want.pop(node, None)
            if kind == "deleted" and want:
                want[node] = (seq, 0)
    assert replica_lists.ordered(replica_lists.apply(listed, whole)) == replica_lists.ordered(want)


@pytest.mark.parametrize("fan", [2, 3])
def test_replica_map_in_a_deep_tree(spark, fan):
    rng = random.Random(fan)
    events = []
    for seq in range(300):
        kind = rng.choice(["store", "corrupt", "fixed", "deleted", "fixed"]) if seq else "store"
        events.append((seq, kind, rng.choice([0, 0, 1]), rng.sample(range(9), 3) if kind == "store" else [rng.randrange(9)]))
    df = spark.createDataFrame(events, "seq bigint, kind string, chunk bigint, nodes array<bigint>")
    got = {r.chunk: r.nodes for r in replica_lists.replica_map(df, 4, fan).collect()}
    assert got == {c: brute([(s, k, n) for s, k, at, n in events if at == c]) for c in (0, 1)}
    assert replica_lists.replica_map(df.where("false")).count() == 0


@pytest.mark.parametrize("block", [5, 50, 10_000])
def test_replica_map_with_deaths(spark, block):
    rng = random.Random(block)
    events, per_chunk, mentioned = [], {}, {}
    for seq in range(400):
        kind = rng.choice(["store", "corrupt", "fixed", "deleted", "dead"])
        chunk = rng.choice([0, 0, 1, 2])
        nodes = rng.sample(range(6), 3) if kind == "store" else [rng.randrange(6)]
        events.append((seq, kind, None if kind == "dead" else chunk, nodes))
        if kind != "dead":
            per_chunk.setdefault(chunk, [])
    for seq, kind, chunk, nodes in events:
        for c in per_chunk if kind == "dead" else [chunk]:
            per_chunk[c].append((seq, kind, nodes))
    df = spark.createDataFrame(events, "seq bigint, kind string, chunk bigint, nodes array<bigint>")
    got = {r.chunk: r.nodes for r in replica_lists.replica_map(df, block).collect()}
    assert got == {c: brute(h) for c, h in per_chunk.items()}


def test_a_block_is_placed_batch_by_batch(monkeypatch):
    """Rows go out before the block has ended, and the next block starts from nothing."""
    monkeypatch.setattr(placement, "OUT_ROWS", 4)
    asked = []

    def batches():
        for block in (0, 1):
            steps = [(1, 1, 5, 10), (1, 2, 6, 20), *((2, seq, 0, 0) for seq in range(3, 7)), (1, 7, 5, 30), (2, 8, 0, 0)]
            for kind, seq, node, free in steps:
                asked.append((block, seq))
                yield pd.DataFrame({"block": [block], "kind": [kind], "seq": [10 * block + seq], "node": [node], "free_space": [free]})

    made = placement._placer(2)(batches())
    assert next(made).to_numpy().tolist() == [[3, 1, 6], [3, 2, 5], [4, 1, 6], [4, 2, 5]] and asked[-1] == (0, 4)
    rest = [tuple(r) for table in made for r in table.to_numpy().tolist()]
    assert rest[4:6] == [(8, 1, 5), (8, 2, 6)] and rest[6:8] == [(13, 1, 6), (13, 2, 5)] and len(rest) == 16
