"""Chunk tables: splitting, slice checksums, scrubbing, repair and reassembly.

Digests are computed where the bytes are and travel instead of them; bytes cross the network only
for chunks that are being rebuilt or joined together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.session import staged

CHUNK_BYTES = 65_536
SLICE_BYTES = 8_192

CHUNK_KEY = ["filename", "chunk_no"]


def pieces(data: Column, size: int) -> Column:
    """The bytes cut into an array of ``size``-byte pieces with a short tail.

    Building the array first keeps a later explode linear: each output row carries one piece and
    never a copy of the whole value.
    """
    count = F.ceil(F.length(data) / size).cast("int")
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: data.substr(i * size + 1, F.lit(size)))


def split(files: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Fixed-size numbered chunks (from 0) of each file."""
    keep = [c for c in files.columns if c != "data"]
    parts = files.select(*keep, F.posexplode(pieces(F.col("data"), chunk_bytes)).alias("chunk_no", "data"))
    return parts.withColumn("chunk_no", F.col("chunk_no").cast("bigint"))


def numbers(files: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk numbers of each file, from its length alone."""
    keep = [c for c in files.columns if c != "data"]
    count = F.ceil(F.length("data") / chunk_bytes).cast("bigint")
    sized = files.select(*keep, count.alias("n")).where(F.col("n") > 0)
    return sized.select(*keep, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("chunk_no"))


def slice_checksums(data: Column, slice_bytes: int = SLICE_BYTES) -> Column:
    """SHA-1 of every slice, in slice order; the last slice is hashed at its real length."""
    return F.transform(pieces(data, slice_bytes), lambda piece: F.sha1(piece))


def manifest(chunks: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """What is known of each chunk as first stored: version 1, path name numbered from 1."""
    return chunks.select(
        "filename",
        "chunk_no",
        F.concat("filename", F.lit("_chunk"), (F.col("chunk_no") + 1).cast("string")).alias("path_name"),
        F.lit(1).cast("bigint").alias("version"),
        F.col("modified_ts").alias("ts"),
        F.length("data").cast("bigint").alias("n_bytes"),
        slice_checksums(F.col("data"), slice_bytes).alias("stored"),
    )


def _bad_slices(stored: Column, current: Column) -> Column:
    """Slices to replace, by number.

    As long as or shorter than stored: every mismatch and the missing tail. Longer than stored:
    everything from the first mismatch on, as all later slices have moved.
    """
    numbers = F.sequence(F.lit(0), F.size(stored) - 1)
    wrong = F.filter(numbers, lambda i: (i >= F.size(current)) | (F.get(stored, i) != F.get(current, i)))
    moved = F.when(F.size(wrong) > 0, F.sequence(F.element_at(wrong, 1), F.size(stored) - 1)).otherwise(wrong)
    return F.when(F.size(stored) >= F.size(current), wrong).otherwise(moved)


def scrub(manifest: DataFrame, replicas: DataFrame, store: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Every listed replica as healthy, corrupt or missing, with its slices to replace.

    Only digests are shuffled, all by chunk, so tables that are bucketed by chunk need no shuffle at all. A chunk
    key has as many rows as it has replicas. A node holds a chunk once.
    """
    digests = store.select(*CHUNK_KEY, "node", slice_checksums(F.col("data"), slice_bytes).alias("current"))
    found = digests.groupBy(*CHUNK_KEY).agg(F.collect_list(F.struct("node", "current")).alias("held"))
    listed = replicas.select(*CHUNK_KEY, "rank", "node")
    known = manifest.select(*CHUNK_KEY, "version", "n_bytes", "stored")
    of_node = F.get(F.filter("held", lambda h: h["node"] == F.col("node")), F.lit(0))["current"]
    checked = listed.join(known, CHUNK_KEY).join(found, CHUNK_KEY, "left").withColumn("current", of_node)
    status = (
        F.when(F.col("current").isNull(), "missing")
        .when(F.col("current") == F.col("stored"), "healthy")
        .otherwise("corrupt")
    )
    return checked.select(
        *CHUNK_KEY, "rank", "node", "version", "n_bytes", status.alias("status"),
        _bad_slices(F.col("stored"), F.coalesce(F.col("current"), F.array().cast("array<string>"))).alias("bad"),
    )


def missing_replicas(replicas: DataFrame, store: DataFrame) -> DataFrame:
    """Replicas listed for a node that the node does not hold."""
    return replicas.join(store.select(*CHUNK_KEY, "node"), [*CHUNK_KEY, "node"], "left_anti")


def repair(scrubbed: DataFrame, store: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Rebuild each corrupt or missing replica from its good slices and the first healthy replica.

    Chunks without a healthy replica yield nothing. The plan, one row for each damaged chunk, is made from
    digest rows and written down first. The stored bytes are then scanned once: while damage is rare the plan
    is small and is broadcast, and only wanted copies move; when it is not, both sides meet by chunk.
    """
    place = F.struct("rank", "node")
    hurt = F.struct("rank", "node", "version", "n_bytes", "status", "bad")
    chunks = scrubbed.groupBy(*CHUNK_KEY).agg(
        F.min(F.when(F.col("status") == "healthy", place))["node"].alias("donor"),
        F.collect_list(F.when(F.col("status") != "healthy", hurt)).alias("hurt"))
    wanted = F.concat(F.array("donor"), F.filter("hurt.node", lambda n: n.isNotNull()))
    plan = staged(chunks.where("donor is not null and size(hurt) > 0").select("*", wanted.alias("wanted")), "repair-plan")
    copies = store.select(*CHUNK_KEY, "node", "data").join(plan.select(*CHUNK_KEY, "wanted"), CHUNK_KEY).where(F.array_contains("wanted", F.col("node")))
    held = copies.groupBy(*CHUNK_KEY).agg(F.collect_list(F.struct("node", "data")).alias("held"))
    rows = plan.join(held, CHUNK_KEY).select(*CHUNK_KEY, "donor", "held", F.explode("hurt").alias("hurt")).select(*CHUNK_KEY, "donor", "held", "hurt.*")
    of = lambda node: F.get(F.filter("held", lambda h: h["node"] == F.col(node)), F.lit(0))["data"]
    joined = rows.select("*", of("donor").alias("donor_data"), of("node").alias("local_data"))
    count = F.ceil(F.col("n_bytes") / slice_bytes).cast("int")
    rebuilt = F.aggregate(
        F.sequence(F.lit(0), count - 1),
        F.lit(b""),
        lambda done, i: F.concat(
            done,
            F.when(F.array_contains("bad", i), F.col("donor_data").substr(i * slice_bytes + 1, F.lit(slice_bytes)))
            .otherwise(F.col("local_data").substr(i * slice_bytes + 1, F.lit(slice_bytes))),
        ),
    )
    return joined.select(
        *CHUNK_KEY, "rank", "node", "donor", "status", (F.col("version") + 1).alias("version"), rebuilt.alias("data")
    )


def read_plan(replicas: DataFrame, chunks_per_block: int = 1_000_000) -> DataFrame:
    """The first listed replica of each chunk and the number of chunks of its file.

    A file's total is summed over blocks of its chunk numbers and joined back by block, so a huge
    file never meets itself in one task.
    """
    block = F.floor(F.col("chunk_no") / chunks_per_block).alias("block")
    first = replicas.groupBy(*CHUNK_KEY).agg(F.min_by("node", "rank").alias("node")).select("*", block)
    total = F.sum("n").over(Window.partitionBy("filename"))
    totals = first.groupBy("filename", "block").agg(F.count("*").alias("n")).select(
        "filename", "block", total.alias("total_chunks")
    )
    return first.join(totals, ["filename", "block"]).select(*CHUNK_KEY, "node", "total_chunks")


CHUNKS_PER_PART = 4_096


def digest_of(checksums: Column) -> Column:
    """One digest for a chunk, from its slice checksums."""
    return F.sha1(F.array_join(checksums, ""))


def reassemble(
    chunks: DataFrame, totals: DataFrame, chunks_per_part: int = CHUNKS_PER_PART,
    manifest: DataFrame | None = None, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Join chunks back into files, for files whose chunks have all arrived.

    A file comes out as numbered parts of at most ``chunks_per_part`` chunks (256 MB at full chunk
    size), so a file of any size stays whole while no task has to hold more than one part. A file
    of up to one part is one row. A chunk that was sent again counts once, by its number. With a
    ``manifest`` (``filename, chunk_no, stored``) only copies whose slices have the recorded checksums
    count, so an altered copy neither stands in for a sound one nor completes a file.

    Completeness is decided on keys and digests; bytes are shuffled once, beside the digests they are held against.
    A table that is bucketed by ``filename`` and a ``part_no`` of the same ``chunks_per_part`` is put together where it lies.
    A table that is bucketed by ``filename`` and a ``part_no`` of the same ``chunks_per_part`` is put together where it lies.
    """
    if "part_no" not in chunks.columns:
        chunks = chunks.withColumn("part_no", F.floor(F.col("chunk_no") / chunks_per_part).cast("bigint"))
    numbered = chunks.select("filename", "part_no", "chunk_no", "data")
    if manifest is not None:
        known = manifest.select(*CHUNK_KEY, digest_of(F.col("stored")).alias("stored"))
        numbered = numbered.withColumn("found", digest_of(slice_checksums(F.col("data"), slice_bytes)))
        keys = numbered.select(*CHUNK_KEY, F.col("found").alias("stored")).distinct().join(known, [*CHUNK_KEY, "stored"], "left_semi")
    else:
        keys = numbered
    have = keys.select(*CHUNK_KEY).distinct().groupBy("filename").agg(F.count("*").alias("received"))
    done = have.join(totals, "filename").where(F.col("received") == F.col("total_chunks"))
    parts = numbered.select("filename", "part_no").distinct().join(done.select("filename"), "filename")
    if manifest is not None:
        told = known.select("filename", F.floor(F.col("chunk_no") / chunks_per_part).cast("bigint").alias("part_no"), "chunk_no",
                            F.lit(None).cast("binary").alias("data"), F.lit(None).cast("string").alias("found"), "stored")
        numbered = numbered.withColumn("stored", F.lit(None).cast("string")).unionByName(told)
    kept = numbered.join(parts, ["filename", "part_no"], "left_semi")
    of_chunk = Window.partitionBy("filename", "part_no", "chunk_no")
    if manifest is not None:
        kept = kept.withColumn("stored", F.max("stored").over(of_chunk)).where("found = stored")
    once = F.row_number().over(of_chunk.orderBy("data"))
    return kept.withColumn("_copy", once).where("_copy = 1").groupBy("filename", "part_no").agg(
        F.expr("listagg(data) WITHIN GROUP (ORDER BY chunk_no)").alias("data"), F.count("*").alias("n_chunks")
    )


def recoverability(scrubbed: DataFrame) -> DataFrame:
    """Healthy replicas of each chunk and whether it can still be read."""
    healthy = F.when(F.col("status") == "healthy", F.col("node"))
    counted = scrubbed.groupBy(*CHUNK_KEY).agg(F.size(F.collect_set(healthy)).cast("bigint").alias("healthy"))
    return counted.withColumn("recoverable", F.col("healthy") >= 1)


def node_inventory(store: DataFrame, nodes: DataFrame) -> DataFrame:
    """Chunks and bytes held by each node and the space left after them."""
    held = store.groupBy("node").agg(F.count("*").alias("held"), F.sum(F.length("data")).alias("held_bytes"))
    zero = F.lit(0).cast("bigint")
    return nodes.join(held, "node", "left").select(
        "node",
        F.coalesce("held", zero).alias("held"),
        F.coalesce("held_bytes", zero).alias("held_bytes"),
        (F.col("free_space") - F.coalesce("held_bytes", zero)).alias("space_left"),
    )
