"""Any six of nine shards bring a chunk back."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from holdfast.functions import galois
from holdfast.operators import chunks, erasure


def test_every_choice_of_six_rows_can_be_inverted():
    matrix = galois.coding_matrix()
    block = np.random.default_rng(0).integers(0, 256, (6, 64), dtype=np.uint8)
    shards = galois.multiply(matrix, block)
    assert (shards[:6] == block).all()
    for rows in combinations(range(9), 6):
        assert (galois.multiply(galois.invert(matrix[list(rows)]), shards[list(rows)]) == block).all()


def sample(spark):
    rows = [("f", i, bytearray(bytes((i * 37 + j) % 256 for j in range(size)))) for i, size in enumerate([1, 2, 8, 100, 100, 1021])]
    return spark.createDataFrame(rows, "filename string, chunk_no bigint, data binary")


def test_frame_and_shard_sizes(spark):
    row = sample(spark).where("chunk_no = 2").select(erasure.framed(F.col("data")).alias("f"), F.col("data")).first()
    assert bytes(row.f) == (8).to_bytes(4, "big") + bytes(row.data)
    shards = erasure.encode(sample(spark)).groupBy("chunk_no").agg(F.count("*").alias("n"), F.max(F.length("data")).alias("size"))
    assert {(r.chunk_no, r.n, r["size"]) for r in shards.collect()} == {
        (0, 9, 1), (1, 9, 1), (2, 9, 2), (3, 9, 18), (4, 9, 18), (5, 9, 171)}


def test_three_lost_shards_are_recovered_and_four_are_not(spark):
    data = sample(spark)
    shards = erasure.encode(data).cache()
    want = {r.chunk_no: bytes(r.data) for r in data.collect()}
    for lost in [(1, 2, 3), (7, 8, 9), (1, 5, 9)]:
        got = erasure.decode(shards.where(~F.col("shard_no").isin(*lost))).collect()
        assert {r.chunk_no: bytes(r.data) for r in got} == want
    assert erasure.decode(shards.where("shard_no > 4")).count() == 0


def test_altered_shards_do_not_count(spark):
    shards = erasure.encode(sample(spark)).cache()
    digests = shards.select("filename", "chunk_no", "shard_no", F.sha1("data").alias("sha1"))
    hurt = shards.withColumn("data", F.when(F.col("shard_no") <= 3, F.lit(b"\x00\x01")).otherwise(F.col("data")))
    good = erasure.good_shards(hurt, digests)
    assert good.count() == 36
    assert {r.chunk_no for r in erasure.decode(good).collect()} == set(range(6))
    assert {(r.good_shards, r.recoverable) for r in erasure.recoverability(good).collect()} == {(6, True)}


def test_overhead_of_full_chunks(spark):
    full = spark.createDataFrame([("f", 0, bytearray(65_536))], "filename string, chunk_no bigint, data binary")
    got = {r.scheme: (r.stored_bytes, round(r.overhead, 3)) for r in erasure.storage_overhead(full, 3).collect()}
    assert got == {"replication": (196_608, 3.0), "erasure": (98_316, 1.5)}


def test_defaults_are_the_full_sizes():
    assert (chunks.CHUNK_BYTES, chunks.SLICE_BYTES) == (65_536, 8_192)
    assert (erasure.DATA_SHARDS, erasure.TOTAL_SHARDS, erasure.HEADER_BYTES) == (6, 9, 4)


def test_resent_shards_count_once(spark):
    shards = erasure.encode(sample(spark))
    five = shards.where("shard_no <= 5").unionByName(shards.where("shard_no = 2"))
    assert erasure.decode(five).count() == 0
    assert not any(r.recoverable for r in erasure.recoverability(five).collect())
    six = shards.where("shard_no <= 6").unionByName(shards.where("shard_no in (1, 6)"))
    assert erasure.decode(six).count() == sample(spark).count()


def broken(shards, wrong, how="flip"):
    """The shards with those numbered in ``wrong`` altered."""
    size = F.length("data")
    flipped = {"flip": F.concat(F.when(F.substring("data", 1, 1) == F.lit(b"\x07"), F.lit(b"\x08")).otherwise(F.lit(b"\x07")), F.col("data").substr(F.lit(2), size)),
               "short": F.lit(b"ab")}[how]
    return shards.withColumn("data", F.when(F.col("shard_no").isin(*wrong), flipped).otherwise(F.col("data")))


def test_without_digests_spare_shards_locate_one_wrong_shard(spark):
    data = sample(spark)
    want = {r.chunk_no: bytes(r.data) for r in data.collect()}
    shards = erasure.encode(data).cache()
    for wrong in range(1, 10):
        for lost in ([], [wrong % 9 + 1]):
            got = erasure.decode(broken(shards, [wrong]).where(~F.col("shard_no").isin(*lost, 0))).collect()
            assert {r.chunk_no: (bytes(r.data), r.proof, r.wrong_shard) for r in got} == {c: (d, "located", wrong) for c, d in want.items()}


def test_seven_shards_show_a_wrong_one_but_not_which(spark):
    shards = erasure.encode(sample(spark)).cache()
    assert {r.proof for r in erasure.decode(shards.where("shard_no > 2")).collect()} == {"spare"}
    assert erasure.decode(broken(shards, [5]).where("shard_no > 2")).count() == 0
    assert {r.proof for r in erasure.decode(shards.where("shard_no > 3")).collect()} == {"none"}


def test_digests_choose_between_copies(spark):
    data = sample(spark)
    want = {r.chunk_no: bytes(r.data) for r in data.collect()}
    shards = erasure.encode(data).cache()
    digests = shards.select("filename", "chunk_no", "shard_no", F.sha1("data").alias("sha1"))
    both = shards.unionByName(broken(shards, range(1, 10)))
    got = erasure.decode(both.unionByName(both), digests).collect()
    assert {r.chunk_no: (bytes(r.data), r.proof) for r in got} == {c: (d, "digest") for c, d in want.items()}
    assert erasure.decode(both).count() == 0  # nothing tells the copies apart
    assert erasure.decode(broken(shards, [1, 2, 3, 4]), digests).count() == 0


def test_digests_known_for_some_shards_only(spark):
    """Five shards are proven, one of the other four is wrong: the proven ones are never suspected."""
    data = sample(spark)
    shards = erasure.encode(data).cache()
    digests = shards.where("shard_no <= 5").select("filename", "chunk_no", "shard_no", F.sha1("data").alias("sha1"))
    got = erasure.decode(broken(shards, [8]), digests).collect()
    assert {(r.chunk_no, r.proof, r.wrong_shard) for r in got} == {(c, "located", 8) for c in range(6)}
    cut = erasure.decode(broken(shards, [7], "short").where("chunk_no > 2"), digests).collect()
    assert {(r.chunk_no, r.proof) for r in cut} == {(c, "spare") for c in range(3, 6)}


def test_chunks_of_all_sizes_are_multiplied_together(spark, monkeypatch):
    """A portion of chunks takes one product, and one more for each choice of six proven shards."""
    frames = [bytes([0, 0, 0, n, *range(1, n + 1), *[0] * (-(n + 4) % 6)]) for n in range(1, 61)]
    batch = pa.RecordBatch.from_pydict({"filename": ["f"] * 60, "chunk_no": list(range(60)), "frame": frames, "step": pa.array([len(f) // 6 for f in frames], pa.int32())})
    products, multiply = [], galois.multiply
    monkeypatch.setattr(galois, "multiply", lambda matrix, block: products.append(1) or multiply(matrix, block))
    galois.coding_matrix()
    products.clear()
    (coded,) = erasure._encode_batches(iter([batch]))
    assert len(products) == 1
    rows = []
    for frame, parity in zip(frames, coded.column("parity").to_pylist(), strict=True):
        step = len(frame) // 6
        every = [frame[i * step:(i + 1) * step] for i in range(6)] + parity
        lost = {1, 5, 9} if len(rows) % 2 else {2, 7, 8}
        rows.append([{"unproven": False, "shard_no": n, "data": every[n - 1]} for n in range(1, 10) if n not in lost])
    shards = pa.array(rows, pa.list_(pa.struct([("unproven", pa.bool_()), ("shard_no", pa.int64()), ("data", pa.binary())])))
    held = pa.RecordBatch.from_arrays([batch.column("filename"), batch.column("chunk_no"), shards], names=["filename", "chunk_no", "shards"])
    products.clear()
    (back,) = erasure._decode_batches(iter([held]))
    assert len(products) == 2
    assert dict(zip(back.column("chunk_no").to_pylist(), back.column("data").to_pylist(), strict=True)) == {n - 1: bytes(range(1, n + 1)) for n in range(1, 61)}


def test_two_wrong_shards_are_never_served(spark):
    data = sample(spark).where("chunk_no > 2")
    shards = erasure.encode(data).cache()
    for wrong in [(1, 2), (6, 7), (8, 9)]:
        assert erasure.decode(broken(shards, wrong)).count() == 0


def test_scrubbed_recoverability_lists_every_chunk(spark):
    shards = erasure.encode(sample(spark)).cache()
    digests = shards.select("filename", "chunk_no", "shard_no", F.sha1("data").alias("sha1"))
    held = broken(shards, [1, 2, 3]).where("chunk_no <> 4")
    got = {r.chunk_no: (r.good_shards, r.recoverable) for r in erasure.scrubbed_recoverability(erasure.scrub(digests, held)).collect()}
    assert got == {c: (6, True) for c in (0, 1, 2, 3, 5)} | {4: (0, False)}
    assert erasure.decode(shards.where("false")).count() == 0
