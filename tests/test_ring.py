"""Ring rules at their edges and against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from holdfast.functions import ring as rx
from holdfast.operators import ring, routing


def peers(spark, *ids: int):
    return spark.createDataFrame([(f"{i:04X}", n) for n, i in enumerate(ids)], "id string, seq bigint")


def best(key: int, ids) -> int:
    return min(ids, key=lambda p: (min(abs(key - p), 65536 - abs(key - p)), (p - key) % 65536))


def measure(spark, a, b):
    return spark.createDataFrame([(a, b)], "a int, b int").select(
        rx.left_distance(F.col("a"), F.col("b")), rx.right_distance(F.col("a"), F.col("b")),
        rx.distance(F.col("a"), F.col("b")), rx.direction(F.col("a"), F.col("b"))).first()


@pytest.mark.parametrize("a, b, want", [
    (5, 5, (0, 65536, 0, "COUNTER_CLOCKWISE")),
    (0, 32768, (32768, 32768, 32768, "COUNTER_CLOCKWISE")),
    (32768, 0, (32768, 32768, 32768, "CLOCKWISE")),
    (65535, 1, (65534, 2, 2, "CLOCKWISE")),
    (1, 65535, (2, 65534, 2, "COUNTER_CLOCKWISE")),
    (10, 20, (65526, 10, 10, "CLOCKWISE")),
])
def test_distances(spark, a, b, want):
    assert tuple(measure(spark, a, b)) == want


def test_first_difference(spark):
    rows = spark.createDataFrame([("0000", "0000"), ("1000", "0000"), ("0100", "0000"), ("0010", "0000"), ("0001", "0000")], "a string, b string")
    assert [r[0] for r in rows.select(rx.first_difference(F.col("a"), F.col("b"))).collect()] == [0, 0, 1, 2, 3]


@pytest.mark.parametrize("ids", [[7], [0, 32768], [10, 20], [0, 65535, 1], [0x1000, 0x1002, 0x9000, 0xFFFF]])
def test_owner_of_every_key(spark, ids):
    got = {r.key_int: r.owner for r in ring.owner_map(peers(spark, *ids)).collect()}
    assert got == {k: best(k, ids) for k in range(65536)}


def test_leaf_sets_of_small_rings(spark):
    assert ring.leaf_set(peers(spark, 7)).collect() == [(7, None, None)]
    assert sorted(ring.leaf_set(peers(spark, 7, 9)).collect()) == [(7, 9, 9), (9, 7, 7)]
    assert sorted(ring.leaf_set(peers(spark, 1, 5, 9)).collect()) == [(1, 9, 5), (5, 1, 9), (9, 5, 1)]


def test_routing_cells_are_the_nearest_of_their_prefix(spark):
    ids = random.Random(3).sample(range(65536), 40)
    cells = routing.routing_table(peers(spark, *ids)).collect()
    want = {}
    for p in ids:
        for o in ids:
            ph, oh = f"{p:04X}", f"{o:04X}"
            if p != o:
                i = next(k for k in range(4) if ph[k] != oh[k])
                want.setdefault((p, i, oh[: i + 1]), []).append(o)
    assert {(c.peer, c.row_no, c.prefix): c.target for c in cells} == {k: best(k[0], v) for k, v in want.items()}


def test_join_and_leave_moves_follow_the_owner_maps(spark):
    ids = random.Random(8).sample(range(65536), 12)
    keys = [f"{k:04X}" for k in random.Random(9).sample(range(65536), 500)]
    files = spark.createDataFrame([(f"n{k}", k) for k in keys], "filename string, key string")
    after, before = peers(spark, *ids), peers(spark, *ids[:-1])
    joined = {r.key: (r.old_owner, r.new_owner) for r in ring.moved_by_join(files, before, after).collect()}
    assert joined == {k: (best(int(k, 16), ids[:-1]), ids[-1]) for k in keys if best(int(k, 16), ids) == ids[-1]}
    left = {r.key: (r.old_owner, r.new_owner) for r in ring.moved_by_leave(files, after, F.lit(ids[0])).collect()}
    assert left == {k: (ids[0], best(int(k, 16), ids[1:])) for k in keys if best(int(k, 16), ids) == ids[0]}


def test_duplicate_identifiers_are_refused(spark):
    asked = spark.createDataFrame([(1, "AAAA"), (0, "AAAA"), (2, "BBBB")], "seq bigint, id string")
    assert {(r.seq, r.id) for r in ring.register(asked).collect()} == {(0, "AAAA"), (2, "BBBB")}
    assert {(r.seq, r.id) for r in ring.conflicts(asked).collect()} == {(1, "AAAA")}


def test_traces_go_once_round(spark):
    ring_of = peers(spark, 1, 16, 0xFFFF)
    assert ring.trace(ring_of, F.lit(16), True).first() == ("0010", "0010-0001-FFFF", "16-1-65535")
    assert ring.trace(ring_of, F.lit(16), False).first() == ("0010", "0010-FFFF-0001", "16-65535-1")


def test_reads_need_name_and_key(spark):
    stored = spark.createDataFrame([("f", "ABCD", 1)], "filename string, key string, owner int")
    asked = spark.createDataFrame([("f", "abcd", 1), ("g", "abcd", 1), ("f", "abce", 1)], "filename string, key string, owner int")
    assert [(r.filename, r.key) for r in ring.read_hits(asked, stored).collect()] == [("f", "ABCD")]
    assert ring.read_misses(asked, stored).count() == 2
