"""Chunk-store tables derived from the given ones: files, nodes, replicas, damage and traffic.

Sizes are parameters because the given documents are small; the defaults below keep the ratio of
the full sizes (65,536-byte chunks and 8,192-byte slices).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators import chunks, erasure
from holdfast.sources.tables import table

CHUNK_BYTES = 1024
SLICE_BYTES = 128
COPIES = 3

# What an event type means for a replica list.
EVENT_KINDS = {"view": "store", "click": "corrupt", "purchase": "fixed", "error": "deleted", "signup": "dead"}


def node_count(spark: SparkSession, sf: str) -> Column:
    return table(spark, sf, "supplier").agg(F.count("*")).scalar()


def nodes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("node"), F.round(F.col("s_acctbal") * 100).cast("bigint").alias("free_space")
    )


def files(spark: SparkSession, sf: str) -> DataFrame:
    modified = F.expr("timestampadd(MINUTE, doc_id, TIMESTAMP_NTZ'2024-01-01 00:00:00')")
    return table(spark, sf, "documents").select(
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("filename"),
        "doc_id",
        F.encode("text", "UTF-8").alias("data"),
        modified.alias("modified_ts"),
    )


def file_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.split(files(spark, sf), CHUNK_BYTES)


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.manifest(file_chunks(spark, sf), SLICE_BYTES)


def _spread(chunk_rows: DataFrame, first: int, last: int, name: str, n: Column) -> DataFrame:
    """One row per copy of a chunk, with the node that should hold it."""
    numbers = F.array(*[F.lit(i).cast("bigint") for i in range(first, last + 1)])
    copies = chunk_rows.withColumn(name, F.explode(numbers))
    return copies.withColumn("node", F.pmod(F.col("doc_id") * 7 + F.col("chunk_no") * 3 + F.col(name), n))


def replica_list(spark: SparkSession, sf: str) -> DataFrame:
    """Which node should hold which replica; no bytes."""
    keys = chunks.numbers(files(spark, sf), CHUNK_BYTES)
    return _spread(keys, 0, COPIES - 1, "rank", node_count(spark, sf)).select("filename", "chunk_no", "rank", "node")


def replica_store(spark: SparkSession, sf: str) -> DataFrame:
    """The bytes each node really holds: some altered, cut, grown or gone."""
    copies = _spread(file_chunks(spark, sf), 0, COPIES - 1, "rank", node_count(spark, sf))
    fate = (F.col("doc_id") * 31 + F.col("chunk_no") * 7 + F.col("rank")) % 11
    size = F.length("data")
    slices = F.ceil(size / SLICE_BYTES)
    spot = ((F.col("doc_id") + F.col("chunk_no")) % slices * SLICE_BYTES + 1).cast("int")
    body = F.col("data")
    altered = F.concat(body.substr(F.lit(1), spot - 1), F.lit(b"\x00"), body.substr(spot + 1, size))
    cut = body.substr(F.lit(1), F.floor(size / 2).cast("int"))
    grown = F.concat(body, F.when(F.col("doc_id") % 2 == 0, F.lit(b"+" * 5)).otherwise(F.lit(b"+" * 150)))
    held = F.when(fate == 0, altered).when(fate == 1, cut).when(fate == 2, grown).otherwise(body)
    return copies.where(fate != 3).select("filename", "chunk_no", "rank", "node", held.alias("data"))


def shard_list(spark: SparkSession, sf: str) -> DataFrame:
    """Which node should hold which of the nine shards of a chunk; no bytes."""
    keys = chunks.numbers(files(spark, sf), CHUNK_BYTES)
    spread = _spread(keys, 1, erasure.TOTAL_SHARDS, "shard_no", node_count(spark, sf))
    return spread.select("filename", "doc_id", "chunk_no", "shard_no", "node")


def lost_shard() -> Column:
    """Drops none to four of the nine shards of a chunk."""
    turn = (F.col("shard_no") + F.col("doc_id") + F.col("chunk_no")) % 9
    return turn < (F.col("doc_id") * 3 + F.col("chunk_no")) % 5


def shard_store(spark: SparkSession, sf: str) -> DataFrame:
    """The shard bytes that are really held: some lost, some with other bytes, some held twice."""
    named = erasure.encode(file_chunks(spark, sf)).withColumn("doc_id", F.substring_index("filename", "/", -1).cast("bigint"))
    kept = named.where(~lost_shard())
    turn = F.col("doc_id") * 5 + F.col("chunk_no") + F.col("shard_no")
    size = F.length("data")
    altered = F.concat(F.unhex(F.lpad(F.hex(255 - F.conv(F.hex(F.substring("data", 1, 1)), 16, 10).cast("int")), 2, "0")),
                       F.col("data").substr(F.lit(2), size))
    # the altered bytes, and every other time a sound copy beside them
    copies = F.when(turn % 14 == 0, F.array(altered, F.col("data"))).when(turn % 7 == 0, F.array(altered)).otherwise(F.array("data"))
    return kept.select(*[F.explode(copies).alias(c) if c == "data" else c for c in kept.columns if c != "doc_id"])


def heartbeats(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of every node in arrival order ``seq``; placement requests are left out."""
    ev = table(spark, sf, "events")
    return ev.where(F.col("event_type") != "purchase").select(
        F.col("event_id").alias("seq"),
        "ts",
        F.pmod("user_id", node_count(spark, sf)).alias("node"),
        F.round(F.col("value") * 100).cast("bigint").alias("free_space"),
    )


def placement_requests(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.where(F.col("event_type") == "purchase").select(F.col("event_id").alias("seq"))


def chunk_writes(spark: SparkSession, sf: str) -> DataFrame:
    """Writes in arrival order; chunk 0 takes a third of them, some older than what is stored."""
    ev = table(spark, sf, "events")
    return ev.select(
        F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")).alias("chunk"),
        (F.floor(F.col("event_id") / 4) + F.floor(F.col("value"))).cast("bigint").alias("write_ts"),
    )


def replica_events(spark: SparkSession, sf: str) -> DataFrame:
    """Replica-list events; chunk 0 takes a third of them. ``dead`` names a node and no chunk."""
    ev = table(spark, sf, "events")
    n = node_count(spark, sf)
    kind = F.create_map(*[F.lit(x) for pair in EVENT_KINDS.items() for x in pair])[F.col("event_type")]
    # a chunk's own nodes come from a band of six, so events of one chunk meet the same nodes
    band = F.pmod(F.col("chunk") * 5 + F.floor(F.col("value")) % 6, n)
    return (
        ev.select(
            F.col("event_id").alias("seq"),
            kind.alias("kind"),
            F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id") % 97).alias("chunk"),
            "value",
        )
        .select("seq", "kind", "chunk", band.cast("bigint").alias("node"), n.alias("n"))
        .select(
            "seq",
            "kind",
            F.when(F.col("kind") != "dead", F.col("chunk")).alias("chunk"),
            F.when(
                F.col("kind") == "store",
                F.transform(F.array(*[F.lit(i) for i in range(COPIES)]), lambda i: F.pmod(F.col("node") + i, F.col("n"))),
            ).otherwise(F.array("node")).alias("nodes"),
        )
    )
