"""Erasure coding of chunks: six data shards, three parity shards, any six rebuild the chunk."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions import galois
from holdfast.operators.chunks import CHUNK_KEY

DATA_SHARDS = 6
PARITY_SHARDS = 3
TOTAL_SHARDS = DATA_SHARDS + PARITY_SHARDS
HEADER_BYTES = 4


def shard_bytes(size: Column) -> Column:
    """Bytes per shard: the chunk and its length header shared out over the data shards."""
    return F.ceil((size + HEADER_BYTES) / DATA_SHARDS)


def framed(data: Column) -> Column:
    """Big-endian length, the bytes, and zeros up to six equal shards."""
    size = F.length(data)
    pad = (shard_bytes(size) * DATA_SHARDS - size - HEADER_BYTES).cast("int")
    return F.concat(F.unhex(F.lpad(F.hex(size), 8, "0")), data, F.unhex(F.repeat(F.lit("00"), pad)))


def _framed_chunks(chunks: DataFrame) -> DataFrame:
    step = shard_bytes(F.length("data")).cast("int")
    return chunks.select(*CHUNK_KEY, framed(F.col("data")).alias("frame"), step.alias("step"))


def _cut() -> Column:
    numbers = F.sequence(F.lit(0), F.lit(DATA_SHARDS - 1))
    return F.transform(numbers, lambda i: F.col("frame").substr(i * F.col("step") + 1, F.col("step")))


def _numbered(shards: DataFrame, parts: Column) -> DataFrame:
    return shards.select(*CHUNK_KEY, F.posexplode(parts).alias("pos", "data")).select(
        *CHUNK_KEY, (F.col("pos") + 1).cast("bigint").alias("shard_no"), "data"
    )


def data_shards(chunks: DataFrame) -> DataFrame:
    """Shards 1 to 6 of every chunk, built from native expressions."""
    return _numbered(_framed_chunks(chunks), _cut())


def _portions(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches cut to a few megabytes of full-size chunks, to bound the working arrays."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parity for each chunk; the chunks of a portion are multiplied together, whatever their sizes."""
    for batch in _portions(batches):
        steps = batch.column("step").to_pylist()
        frames = [np.frombuffer(f.as_buffer(), np.uint8).reshape(DATA_SHARDS, step) for f, step in zip(batch.column("frame"), steps, strict=True)]
        out = galois.multiply(galois.coding_matrix()[DATA_SHARDS:], np.concatenate(frames, axis=1))
        parity = [[row[end - step:end].tobytes() for row in out] for step, end in zip(steps, accumulate(steps), strict=True)]
        kept = ["filename", "chunk_no", "frame", "step"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(parity, pa.list_(pa.binary()))], names=[*kept, "parity"]
        )


def encode(chunks: DataFrame) -> DataFrame:
    """All nine shards of every chunk in one pass over the chunks and without a shuffle."""
    coded = _framed_chunks(chunks).mapInArrow(
        _encode_batches, "filename string, chunk_no bigint, frame binary, step int, parity array<binary>"
    )
    return _numbered(coded, F.concat(_cut(), F.col("parity")))


@lru_cache(maxsize=128)
def _inverse(rows: bytes) -> np.ndarray:
    """Inverse of six coding rows; of nine there are 84 choices."""
    return galois.invert(np.frombuffer(rows, np.uint8).reshape(DATA_SHARDS, DATA_SHARDS))


def _agreeing(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Data rebuilt from the first six rows of ``block``, and where the other rows are what that data gives.

    ``block`` is (shards, members, bytes) and ``matrix`` has the coding row of each shard.
    """
    n, members, step = block.shape
    first = galois.multiply(_inverse(matrix[:DATA_SHARDS].tobytes()), block[:DATA_SHARDS].reshape(DATA_SHARDS, -1))
    spare = galois.multiply(matrix[DATA_SHARDS:], first).reshape(n - DATA_SHARDS, members, step)
    return first.reshape(DATA_SHARDS, members, step), (spare == block[DATA_SHARDS:]).all(axis=(0, 2))


def _settle(numbers: tuple[int, ...], proven: int, block: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, str, int | None]]:
    """``(members, data, proof, wrong shard)`` for chunks that hold the same shards, the ``proven`` ones first, fewer than six.

    Nine shards of which six are data have distance four: seven shards show that one is wrong, eight or nine
    also show which. Members that cannot be settled are not given.
    """
    matrix = galois.coding_matrix()[[n - 1 for n in numbers]]
    everyone = np.arange(block.shape[1])
    data, agree = _agreeing(matrix, block)
    agree &= _plausible(data)
    if agree.any():
        yield everyone[agree], data[:, agree], "spare" if len(numbers) > DATA_SHARDS else "none", None
    open_ = everyone[~agree]
    for suspect in range(proven, len(numbers)) if len(numbers) >= DATA_SHARDS + 2 else []:
        if not len(open_):
            break
        rest = [i for i in range(len(numbers)) if i != suspect]
        data, agree = _agreeing(matrix[rest], block[rest][:, open_])
        agree &= _plausible(data)
        if agree.any():
            yield open_[agree], data[:, agree], "located", numbers[suspect]
            open_ = open_[~agree]


def _plausible(data: np.ndarray) -> np.ndarray:
    """Frames whose length header fits the shard size and whose padding is zero."""
    _, members, step = data.shape
    frames = data.transpose(1, 0, 2).reshape(members, -1)
    size = frames[:, :HEADER_BYTES].astype(np.int64) @ (1 << np.arange(24, -1, -8))
    fits = -(-(size + HEADER_BYTES) // DATA_SHARDS) == step
    tail = np.arange(frames.shape[1])[None, -DATA_SHARDS:] >= HEADER_BYTES + size[:, None]
    return fits & ~((frames[:, -DATA_SHARDS:] != 0) & tail).any(axis=1)


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rebuild chunks from the shards that are left.

    Chunks with the same six proven shards are multiplied together, whatever their sizes; others with those of the same shards and sizes.
    """
    for batch in _portions(batches):
        sound: dict[tuple, list[tuple[int, list[bytes]]]] = {}
        groups: dict[tuple, list[tuple[int, list[bytes]]]] = {}
        lists = batch.column("shards")
        unproven, shard_no, data = (column.to_pylist() for column in lists.flatten().flatten())
        lengths = lists.value_lengths().to_pylist()
        for at, (n, end) in enumerate(zip(lengths, accumulate(lengths), strict=True)):
            shards = list(zip(unproven[end - n:end], shard_no[end - n:end], data[end - n:end], strict=True))
            sizes = [len(d) for _, _, d in shards]
            proven = [len(d) for open_, _, d in shards if not open_]
            step = proven[0] if proven else max(set(sizes), key=lambda size: (sizes.count(size), size))
            used = [s for s in shards if len(s[2]) == step]
            if len(used) < DATA_SHARDS or not step:
                continue
            numbers, known = tuple(s[1] for s in used), sum(not s[0] for s in used)
            if known >= DATA_SHARDS:
                sound.setdefault(numbers[:DATA_SHARDS], []).append((at, [s[2] for s in used[:DATA_SHARDS]]))
            else:
                groups.setdefault((numbers, known, step), []).append((at, [s[2] for s in used]))
        rows, out, proofs, wrong = [], [], [], []

        def found(row: int, data: np.ndarray, proof: str, suspect: int | None) -> None:
            frame = data.tobytes()
            rows.append(row)
            out.append(frame[HEADER_BYTES:HEADER_BYTES + int.from_bytes(frame[:HEADER_BYTES], "big")])
            proofs.append(proof)
            wrong.append(suspect)

        for numbers, members in sound.items():
            block = np.concatenate([np.frombuffer(b"".join(held), np.uint8).reshape(DATA_SHARDS, -1) for _, held in members], axis=1)
            data = galois.multiply(_inverse(galois.coding_matrix()[[n - 1 for n in numbers]].tobytes()), block)
            for (row, held), end in zip(members, accumulate(len(held[0]) for _, held in members), strict=True):
                found(row, data[:, end - len(held[0]):end], "digest", None)
        for (numbers, proven, _), members in groups.items():
            block = np.stack([np.stack([np.frombuffer(d, np.uint8) for d in held]) for _, held in members]).transpose(1, 0, 2)
            for settled, data, proof, suspect in _settle(numbers, proven, block):
                for i, member in enumerate(settled):
                    found(members[member][0], data[:, i], proof, suspect)
        taken = batch.select(CHUNK_KEY).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*taken.columns, pa.array(out, pa.binary()), pa.array(proofs, pa.string()), pa.array(wrong, pa.int64())],
            names=[*CHUNK_KEY, "data", "proof", "wrong_shard"])


def good_shards(shards: DataFrame, digests: DataFrame) -> DataFrame:
    """Shards that arrived and still have the digest recorded for them."""
    key = [*CHUNK_KEY, "shard_no"]
    checked = shards.withColumn("found", F.sha1("data")).join(digests.select(*key, "sha1"), key)
    return checked.where(F.col("found") == F.col("sha1")).select(*key, "data")


def scrub(digests: DataFrame, stored: DataFrame) -> DataFrame:
    """Each shard of ``digests`` as healthy, corrupt or missing, by the digest of the bytes that are stored.

    A shard that is stored more than once is healthy if one copy is. Only digests are shuffled.
    """
    key = [*CHUNK_KEY, "shard_no"]
    found = stored.select(*key, F.sha1("data").alias("found"))
    sound = F.coalesce(F.bool_or(F.col("found") == F.col("sha1")), F.lit(False))
    status = F.when(sound, "healthy").when(F.count("found") > 0, "corrupt").otherwise("missing")
    return digests.select(*key, "sha1").join(found, key, "left").groupBy(*key).agg(status.alias("status"))


def _usable_shards(shards: DataFrame, digests: DataFrame | None) -> DataFrame:
    """One version of each shard, per chunk: ``(filename, chunk_no, shards)``, those with a proof first.

    A shard whose digest is recorded counts only with that digest. One without counts if all its copies agree.
    Equal copies are reduced to one in each task before bytes are shuffled; a wrong copy never outlives its chunk's list of digests.
    """
    versions = shards.groupBy(*CHUNK_KEY, "shard_no", F.sha1("data").alias("found")).agg(F.min("data").alias("data"))
    pair = F.struct(F.col("shard_no").cast("bigint").alias("shard_no"), F.col("found").alias("sha1"))
    if digests is None:
        judged = versions.withColumn("unproven", F.lit(True))
    else:
        listed = digests.groupBy(*CHUNK_KEY).agg(F.collect_set(F.struct(F.col("shard_no").cast("bigint").alias("shard_no"), "sha1")).alias("known"))
        joined = versions.join(listed, CHUNK_KEY, "left")
        no_digest = F.coalesce(~F.exists("known", lambda k: k["shard_no"] == F.col("shard_no")), F.lit(True))
        sound = F.coalesce(F.array_contains("known", pair), F.lit(False))
        judged = joined.where(sound | no_digest).select(*CHUNK_KEY, "shard_no", "data", (~sound).alias("unproven"))
    once = judged.groupBy(*CHUNK_KEY, "shard_no").agg(
        F.min("data").alias("data"), F.bool_or("unproven").alias("unproven"), F.count("*").alias("versions"))
    agreed = once.where((F.col("versions") == 1) | ~F.col("unproven"))
    row = F.struct("unproven", F.col("shard_no").cast("bigint").alias("shard_no"), "data")
    return agreed.groupBy(*CHUNK_KEY).agg(F.array_sort(F.collect_list(row)).alias("shards")).where(F.size("shards") >= DATA_SHARDS)


def decode(shards: DataFrame, digests: DataFrame | None = None) -> DataFrame:
    """Chunks rebuilt from six or more different shards: ``filename, chunk_no, data, proof, wrong_shard``.

    ``digests`` (``filename, chunk_no, shard_no, sha1``) is what was recorded when the shards were written. A
    shard that differs from its digest is not used. Where digests are missing, spare shards tell: ``proof`` is

    * ``digest``: six shards have their recorded digest;
    * ``spare``: seven or more shards agree;
    * ``located``: one of eight or nine shards disagrees, is named in ``wrong_shard`` and was left out;
    * ``none``: exactly six shards and no digest for all of them, so nothing speaks for the bytes.

    Chunks with fewer usable shards, and those whose shards contradict each other in any other way, give no row.
    A shard that was sent again counts once; copies that differ, without a digest to choose by, count as lost.
    """
    return _usable_shards(shards, digests).mapInArrow(
        _decode_batches, "filename string, chunk_no bigint, data binary, proof string, wrong_shard bigint")


def recoverability(shards: DataFrame) -> DataFrame:
    """Different good shards of each chunk and whether six of them are left."""
    counted = shards.select(*CHUNK_KEY, "shard_no").distinct().groupBy(*CHUNK_KEY).agg(F.count("*").alias("good_shards"))
    return counted.withColumn("recoverable", F.col("good_shards") >= DATA_SHARDS)


def scrubbed_recoverability(scrubbed: DataFrame) -> DataFrame:
    """Shards of each chunk that still have their recorded digest, and whether six are left; chunks with none are listed too."""
    counted = scrubbed.groupBy(*CHUNK_KEY).agg(F.count_if(F.col("status") == "healthy").alias("good_shards"))
    return counted.withColumn("recoverable", F.col("good_shards") >= DATA_SHARDS)


def storage_overhead(chunks: DataFrame, copies: int) -> DataFrame:
    """Bytes stored per byte of payload under replication and under erasure coding."""
    size = F.length("data").cast("bigint")
    totals = chunks.agg(
        F.sum(size).alias("payload"), F.sum(shard_bytes(size) * TOTAL_SHARDS).cast("bigint").alias("sharded")
    )
    stored = F.stack(
        F.lit(2), F.lit("replication"), F.col("payload") * copies, F.lit("erasure"), F.col("sharded")
    ).alias("scheme", "stored_bytes")
    rows = totals.select("payload", stored)
    return rows.select(
        "scheme", F.col("payload").alias("payload_bytes"), "stored_bytes",
        (F.col("stored_bytes") / F.col("payload")).alias("overhead"),
    )
