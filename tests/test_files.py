"""Files by byte ranges, bounded line files, and tables that join without a shuffle."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from holdfast.operators import chunks
from holdfast.session import fresh_path
from holdfast.sources import binary_files, byte_ranges
from tests.test_plans import plan


@pytest.fixture
def folder(tmp_path):
    bodies = {"a/big.bin": os.urandom(1_000_003), "b.bin": b"", "c.bin": b"x" * 4096, "a/d.bin": b"y", "_hidden": b"zz", "a/.crc": b"z", "_temporary/part-0": b"q"}
    for name, body in bodies.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)
    return tmp_path, {n: b for n, b in bodies.items() if n in ("a/big.bin", "b.bin", "c.bin", "a/d.bin")}


def test_ranges_give_every_chunk_once(spark, folder):
    path, bodies = folder
    rows = byte_ranges.read_chunks(spark, str(path), 4096, 20_000)
    got = {}
    for r in rows.collect():
        assert len(r.data) <= 4096
        got.setdefault(r.path.removeprefix(f"{path}/"), []).append((r.chunk_no, bytes(r.data), r.file_bytes))
    for name, body in bodies.items():
        mine = sorted(got.get(name, []))
        assert [c for c, _, _ in mine] == list(range(-(-len(body) // 4096)))
        assert b"".join(d for _, d, _ in mine) == body and all(n == len(body) for _, _, n in mine)
    assert rows.rdd.getNumPartitions() >= 1_000_003 // 20_000
    one = byte_ranges.read_chunks(spark, f"file://{path}/c.bin", 1000)
    assert sorted((r.chunk_no, len(r.data)) for r in one.collect()) == [(0, 1000), (1, 1000), (2, 1000), (3, 1000), (4, 96)]


def test_a_missing_path_is_an_error(tmp_path):
    with pytest.raises(FileNotFoundError):
        byte_ranges._Reader(f"{tmp_path}/none", 1, 1).partitions()


def test_a_file_beyond_two_gigabytes_is_cut(spark, tmp_path):
    size = (2 << 30) + 70_000
    with open(tmp_path / "huge", "wb") as file:
        file.truncate(size)
        file.seek(size - 3)
        file.write(b"end")
    parts = byte_ranges._Reader(str(tmp_path), byte_ranges.CHUNK_BYTES, byte_ranges.RANGE_BYTES).partitions()
    assert len(parts) == 17 and all(stop - start <= byte_ranges.RANGE_BYTES for p in parts for _, _, start, stop in p.parts)
    rows = byte_ranges.read_chunks(spark, str(tmp_path))
    total = rows.agg(F.count("*").alias("n"), F.sum(F.length("data").cast("bigint")).alias("b"), F.max("chunk_no").alias("last")).first()
    assert (total.n, total.b, total["last"]) == (-(-size // 65_536), size, size // 65_536)
    assert bytes(rows.where(F.col("chunk_no") == size // 65_536).first().data).endswith(b"end")


def test_small_files_share_a_task():
    parts = list(byte_ranges.cut_ranges([(f"f{i}", 100) for i in range(100)] + [("g", 2_500)], 100, 1000))
    assert len(parts) == 13 and sum(len(p.parts) for p in parts) == 103


def test_many_ranges_share_a_task(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"f{i:02d}").write_bytes(os.urandom(1_000 + i))
    whole = byte_ranges.read_chunks(spark, str(tmp_path), 100, 300)
    few = byte_ranges.read_chunks(spark, str(tmp_path), 100, 300, tasks=5)
    assert whole.rdd.getNumPartitions() >= 40 and 5 <= few.rdd.getNumPartitions() <= 6
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, whole.collect()))
    assert all(stop - start <= 300 for p in byte_ranges._Reader(str(tmp_path), 100, 300, 5).partitions() for _, _, start, stop in p.parts)


def test_line_files_are_bounded_by_bytes(spark):
    texts = spark.createDataFrame([("s" * (i % 7),) for i in range(3000)] + [("m" * 2_000,) for _ in range(300)] + [("l" * 150_000,), (None,)], "text string")
    path = fresh_path(spark, "lines")
    binary_files.write_lines(texts, path, file_bytes=100_000)
    files = binary_files.read(spark, path)
    assert files.where("length > 100000").count() == 1
    got = {r.line: r["count"] for r in binary_files.lines(files).groupBy("line").count().collect()}
    assert got == {"s" * k: 3000 // 7 + (k < 3000 % 7) + (k == 0) for k in range(7)} | {"m" * 2_000: 300, "l" * 150_000: 1}


def store(spark):
    files = spark.createDataFrame([(f"f{i}", bytearray(os.urandom(500 + 37 * i))) for i in range(40)], "filename string, data binary").withColumn(
        "modified_ts", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))
    parts = chunks.split(files, 100)
    replicas = parts.select("filename", "chunk_no", F.posexplode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("rank", "node")).select(
        "filename", "chunk_no", F.col("rank").cast("bigint").alias("rank"), F.col("node").cast("bigint").alias("node"))
    bytes_ = parts.join(replicas, ["filename", "chunk_no"])
    held = bytes_.withColumn("data", F.when((F.col("chunk_no") + F.col("rank")) % 4 == 0, F.concat(F.lit(b"?"), F.col("data").substr(F.lit(2), F.lit(99)))).otherwise(F.col("data")))
    held = held.where("(chunk_no * 5 + rank) % 7 <> 0").select("filename", "chunk_no", "node", "data")
    return parts, chunks.manifest(parts, 16), replicas, held


def test_bucketed_tables_scrub_and_repair_without_a_shuffle(spark):
    parts, manifest, replicas, held = (df.cache() for df in store(spark))
    tables = [binary_files.write_bucketed(df, fresh_path(spark, "bucketed"), 8, writers=w) for df, w in ((manifest, 1), (replicas, 1), (held, 2))]
    scrubbed = chunks.scrub(*tables, 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(chunks.scrub(*tables, 16))
        joined = tables[2].join(tables[0], ["filename", "chunk_no"])
        assert "Exchange" not in plan(joined)
        fixed = plan(chunks.repair(chunks.scrub(*tables, 16), tables[2], 16))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert fixed.split("\n\n")[0].count("Scan parquet spark_catalog") == 1  # stored bytes are read once; the plan comes from its own table
    plain = chunks.scrub(manifest, replicas, held, 16)
    assert sorted(map(str, scrubbed.collect())) == sorted(map(str, plain.collect()))
    same = lambda df: {(r.filename, r.chunk_no, r.node, bytes(r.data)) for r in df.collect()}
    original = {(r.filename, r.chunk_no): bytes(r.data) for r in parts.collect()}
    repaired = same(chunks.repair(scrubbed, tables[2], 16))
    assert repaired == same(chunks.repair(plain, held, 16)) and all(data == original[f, c] for f, c, _, data in repaired)


def test_parts_reassemble_where_they_lie(spark):
    """Bytes bucketed by file and part are not shuffled again."""
    parts, *_ = store(spark)
    keyed = parts.select("filename", F.floor(F.col("chunk_no") / 4).cast("bigint").alias("part_no"), "chunk_no", "data")
    table = binary_files.write_bucketed(keyed, fresh_path(spark, "bucketed"), 8, ["filename", "part_no"])
    totals = parts.groupBy("filename").agg(F.count("*").alias("total_chunks"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(chunks.reassemble(table, totals, chunks_per_part=4))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not any("data" in line for block in text.split("\n\n") if "Exchange" in block.split("\n")[0] for line in block.split("\n") if line.startswith("Input"))


def test_a_table_is_found_again(spark):
    parts, manifest, *_ = store(spark)
    path = fresh_path(spark, "chunk-table")
    binary_files.write_chunk_table(parts, manifest, path, buckets=4)
    data, meta = binary_files.read_chunk_table(spark, path, buckets=4)
    assert data.count() == parts.count() and meta.count() == manifest.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(data.join(meta, ["filename", "chunk_no"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
