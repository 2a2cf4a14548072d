"""Chunk tables on small hand-made files."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from holdfast.operators import chunks

SLICE = 4


def sha(data: bytes) -> str:
    return hashlib.sha1(data).hexdigest()


def files(spark, **contents: bytes):
    rows = [(name, bytearray(data)) for name, data in contents.items()]
    return spark.createDataFrame(rows, "filename string, data binary").withColumn(
        "modified_ts", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))


def store_of(spark, *rows):
    return spark.createDataFrame([(f, c, n, bytearray(d)) for f, c, n, d in rows],
                                 "filename string, chunk_no bigint, node bigint, data binary")


def test_split_has_a_short_tail_and_no_chunk_for_an_empty_file(spark):
    got = chunks.split(files(spark, a=b"0123456789", b=b"", c=b"01234"), 5).collect()
    assert {(r.filename, r.chunk_no): bytes(r.data) for r in got} == {
        ("a", 0): b"01234", ("a", 1): b"56789", ("c", 0): b"01234"}
    numbers = chunks.numbers(files(spark, a=b"0123456789", b=b"", c=b"01234"), 5).collect()
    assert {(r.filename, r.chunk_no) for r in numbers} == {("a", 0), ("a", 1), ("c", 0)}


def test_last_full_slice_is_hashed_at_its_real_length(spark):
    data = b"abcdefgh"
    row = files(spark, a=data).select(chunks.slice_checksums(F.col("data"), SLICE).alias("s")).first()
    assert row.s == [sha(b"abcd"), sha(b"efgh")]


GOOD = b"aaaabbbbccccdd"


@pytest.mark.parametrize("held, status, bad", [
    (GOOD, "healthy", []),
    (b"aaaaXbbbccccdd", "corrupt", [1]),
    (b"aaaabbbb", "corrupt", [2, 3]),
    (b"aaaaXbbb", "corrupt", [1, 2, 3]),
    (b"", "corrupt", [0, 1, 2, 3]),
    (b"aaaabbbbccccddxxxxxx", "corrupt", [3]),
    (b"aaXabbbbccccddxxxxxx", "corrupt", [0, 1, 2, 3]),
    (b"aaaabbbbccccdX", "corrupt", [3]),
    (None, "missing", [0, 1, 2, 3]),
])
def test_scrub_and_repair(spark, held, status, bad):
    manifest = chunks.manifest(chunks.split(files(spark, f=GOOD), 64), SLICE)
    replicas = spark.createDataFrame([("f", 0, 0, 7), ("f", 0, 1, 8)], "filename string, chunk_no bigint, rank bigint, node bigint")
    kept = [("f", 0, 8, GOOD)] + ([("f", 0, 7, held)] if held is not None else [])
    store = store_of(spark, *kept)
    scrubbed = chunks.scrub(manifest, replicas, store, SLICE)
    row = scrubbed.where("node = 7").first()
    assert (row.status, row.bad) == (status, bad)
    fixed = chunks.repair(scrubbed, store, SLICE).collect()
    if status == "healthy":
        assert fixed == []
    else:
        assert [(bytes(r.data), r.donor, r.version) for r in fixed] == [(GOOD, 8, 2)]


def test_grown_chunk_without_mismatch_is_corrupt_and_cut_back(spark):
    good = b"aaaabbbb"
    manifest = chunks.manifest(chunks.split(files(spark, f=good), 64), SLICE)
    replicas = spark.createDataFrame([("f", 0, 0, 7), ("f", 0, 1, 8)], "filename string, chunk_no bigint, rank bigint, node bigint")
    store = store_of(spark, ("f", 0, 7, good + b"xx"), ("f", 0, 8, good))
    scrubbed = chunks.scrub(manifest, replicas, store, SLICE)
    row = scrubbed.where("node = 7").first()
    assert (row.status, row.bad) == ("corrupt", [])
    assert bytes(chunks.repair(scrubbed, store, SLICE).first().data) == good


def test_donor_is_the_first_healthy_replica(spark):
    manifest = chunks.manifest(chunks.split(files(spark, f=GOOD), 64), SLICE)
    replicas = spark.createDataFrame([("f", 0, r, n) for r, n in enumerate([5, 6, 7])], "filename string, chunk_no bigint, rank bigint, node bigint")
    store = store_of(spark, ("f", 0, 5, b"zz"), ("f", 0, 6, b"aaaa"), ("f", 0, 7, GOOD))
    fixed = chunks.repair(chunks.scrub(manifest, replicas, store, SLICE), store, SLICE).collect()
    assert {(r.node, r.donor) for r in fixed} == {(5, 7), (6, 7)}
    none = store_of(spark, ("f", 0, 5, b"zz"))
    assert chunks.repair(chunks.scrub(manifest, replicas, none, SLICE), none, SLICE).count() == 0


def test_reassemble_needs_every_chunk_and_splits_long_files_into_parts(spark):
    all_chunks = chunks.split(files(spark, a=b"0123456789", b=b"abcdef"), 2)
    totals = all_chunks.groupBy("filename").agg(F.count("*").alias("total_chunks"))
    arrived = all_chunks.where("not (filename = 'b' and chunk_no = 1)")
    got = chunks.reassemble(arrived, totals, chunks_per_part=2).orderBy("part_no").collect()
    assert [(r.filename, r.part_no, bytes(r.data)) for r in got] == [("a", 0, b"0123"), ("a", 1, b"4567"), ("a", 2, b"89")]
    whole = chunks.reassemble(arrived, totals).collect()
    assert [(r.filename, bytes(r.data)) for r in whole] == [("a", b"0123456789")]


def test_a_resent_chunk_counts_once(spark):
    rows = [("f", 0, bytearray(b"AA")), ("f", 0, bytearray(b"AA")), ("f", 2, bytearray(b"CC")), ("g", 0, bytearray(b"A")), ("g", 0, bytearray(b"A")), ("g", 1, bytearray(b"B"))]
    arrived = spark.createDataFrame(rows, "filename string, chunk_no bigint, data binary")
    totals = spark.createDataFrame([("f", 3), ("g", 2)], "filename string, total_chunks bigint")
    assert [(r.filename, bytes(r.data), r.n_chunks) for r in chunks.reassemble(arrived, totals).collect()] == [("g", b"AB", 2)]


def test_a_replica_that_is_listed_twice_is_one(spark):
    rows = [("f", 0, 1, "healthy"), ("f", 0, 1, "healthy"), ("f", 0, 2, "corrupt")]
    seen = spark.createDataFrame(rows, "filename string, chunk_no bigint, node bigint, status string")
    assert [(r.healthy, r.recoverable) for r in chunks.recoverability(seen).collect()] == [(1, True)]


def test_only_copies_with_the_recorded_checksums_count(spark):
    rows = [("f", 0, b"\x00" * 8 + b"bbbb"), ("f", 0, b"aaaaaaaabbbb"), ("f", 0, b"aaaaaaaabbbb"), ("f", 1, b"tail"), ("g", 0, b"x" * 12), ("g", 1, b"wrong")]
    arrived = spark.createDataFrame(rows, "filename string, chunk_no bigint, data binary")
    sound = spark.createDataFrame([("f", 0, b"aaaaaaaabbbb"), ("f", 1, b"tail"), ("g", 0, b"x" * 12), ("g", 1, b"right")], "filename string, chunk_no bigint, data binary")
    manifest = sound.select("filename", "chunk_no", chunks.slice_checksums(F.col("data"), 8).alias("stored"))
    totals = spark.createDataFrame([("f", 2), ("g", 2)], "filename string, total_chunks bigint")
    got = chunks.reassemble(arrived, totals, manifest=manifest, slice_bytes=8).collect()
    assert [(r.filename, bytes(r.data), r.n_chunks) for r in got] == [("f", b"aaaaaaaabbbbtail", 2)]
