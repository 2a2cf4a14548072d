"""Membership, ownership and rebalancing on the key ring.

Peers have distinct 16-bit identifiers, so every peer table has at most 65,536 rows. That is the
proven bound behind the broadcasts and the ungrouped windows below. Files and requests have no
bound; they only ever meet peers through equi-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import ring as rx
from holdfast.operators.running import first_per_key


def register(requests: DataFrame, seq: str = "seq") -> DataFrame:
    """The first request for an identifier gets it."""
    return requests.groupBy("id").agg(F.min_by(F.struct(*requests.columns), seq).alias("first")).select("first.*")


def conflicts(requests: DataFrame, seq: str = "seq") -> DataFrame:
    """Requests for a taken identifier, which have to draw another."""
    return first_per_key(requests, "id", seq).where(F.col("status") == 0).drop("status")


def _ids(peers: DataFrame) -> DataFrame:
    return peers.select(rx.to_int(F.col("id")).alias("peer"))


def leaf_set(peers: DataFrame) -> DataFrame:
    """Left and right neighbour of each peer around the ring; none for a lone peer."""
    around = Window.orderBy("peer")
    everyone = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.coalesce(F.lag("peer").over(around), F.max("peer").over(everyone))
    right = F.coalesce(F.lead("peer").over(around), F.min("peer").over(everyone))
    sides = _ids(peers).select("peer", left.alias("left"), right.alias("right"))
    other = lambda side: F.when(F.col(side) != F.col("peer"), F.col(side)).alias(side)
    return sides.select("peer", other("left"), other("right"))


def owner_map(peers: DataFrame) -> DataFrame:
    """The owner of each of the 65,536 keys.

    Each peer lists the keys from itself to its right neighbour; the owner of such a key is one of
    the two.
    """
    me, following = F.col("peer"), F.coalesce(F.col("right"), F.col("peer"))
    gap = rx.right_distance(me, following)
    arcs = leaf_set(peers).select(
        "peer", following.alias("following"), F.explode(F.sequence(F.lit(0), gap - 1)).alias("step")
    )
    key = F.pmod(me + F.col("step"), F.lit(rx.SPACE))
    return arcs.select(key.alias("key_int"), rx.nearer(key, me, F.col("following")).alias("owner"))


def assign(keys: DataFrame, peers: DataFrame) -> DataFrame:
    """Add the owning peer to rows with a ``key``. The broadcast map has 65,536 rows at most."""
    keyed = keys.withColumn("key_int", rx.to_int(F.upper("key")))
    return keyed.join(F.broadcast(owner_map(peers)), "key_int").drop("key_int")


def moved_by_join(files: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Files whose owner changes when a peer joins.

    Compares the two owner maps first, so unaffected files are dropped by one broadcast join.
    """
    old = owner_map(before).withColumnRenamed("owner", "old_owner")
    new = owner_map(after).withColumnRenamed("owner", "new_owner")
    changed = old.join(new, "key_int").where(F.col("old_owner") != F.col("new_owner"))
    keyed = files.withColumn("key_int", rx.to_int(F.upper("key")))
    return keyed.join(F.broadcast(changed), "key_int").drop("key_int")


def moved_by_leave(files: DataFrame, peers: DataFrame, leaver: Column) -> DataFrame:
    """Files of a leaving peer and the neighbour that takes each.

    ``leaver`` is the identifier of the peer as a one-value column, such as a scalar subquery.
    """
    keys = owner_map(peers).where(F.col("owner") == leaver)
    near = leaf_set(peers).where(F.col("left").isNotNull())
    taken = keys.join(near.withColumnRenamed("peer", "owner"), "owner").select(
        "key_int", F.col("owner").alias("old_owner"),
        rx.nearer(F.col("key_int"), F.col("left"), F.col("right")).alias("new_owner"),
    )
    keyed = files.withColumn("key_int", rx.to_int(F.upper("key")))
    return keyed.join(F.broadcast(taken), "key_int").drop("key_int")


def trace(peers: DataFrame, origin: Column, leftward: bool) -> DataFrame:
    """Identifiers met on a walk once around the ring from ``origin``, in hex and decimal."""
    start = F.col("origin")
    walk = rx.left_distance(start, F.col("peer")) if leftward else F.pmod(F.col("peer") - start, F.lit(rx.SPACE))
    steps = _ids(peers).withColumn("origin", origin)
    path = F.array_sort(F.collect_list(F.struct(walk.alias("step"), "peer")))
    ids = F.transform("path", lambda s: s["peer"])
    return steps.groupBy("origin").agg(path.alias("path")).select(
        rx.to_hex(F.col("origin")).alias("origin"),
        F.array_join(F.transform(ids, rx.to_hex), "-").alias("hex_trace"),
        F.array_join(F.transform(ids, lambda p: p.cast("string")), "-").alias("decimal_trace"),
    )


def numbered(peers: DataFrame) -> DataFrame:
    """Peers with a running number from 1 in identifier order and the total."""
    return peers.withColumn("number", F.row_number().over(Window.orderBy("id")).cast("bigint")).withColumn(
        "total", F.count("*").over(Window.partitionBy())
    )


def entry_peer(requests: DataFrame, peers: DataFrame, name: str) -> DataFrame:
    """A peer to start from for each request, picked by a hash of ``name``."""
    listed = numbered(peers).select(F.col("number").alias("pick"), F.col("id").alias("entry"))
    total = peers.agg(F.count("*")).scalar()
    draw = F.conv(F.substring(F.sha1(F.col(name).cast("binary")), 9, 8), 16, 10).cast("bigint")
    return requests.withColumn("pick", F.pmod(draw, total) + 1).join(F.broadcast(listed), "pick").drop("pick")


def files_per_peer(owned: DataFrame) -> DataFrame:
    """Files of each peer with the peer's file count: one count per peer, so at most 65,536."""
    counts = owned.groupBy("owner").agg(F.count("*").alias("files"))
    return owned.join(F.broadcast(counts), "owner")


def read_hits(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Requests whose name and key are both stored at the owner of the key."""
    at = stored.select("owner", "filename", F.upper("key").alias("key"))
    return requests.withColumn("key", F.upper("key")).join(at, ["owner", "filename", "key"], "left_semi")


def read_misses(requests: DataFrame, stored: DataFrame) -> DataFrame:
    at = stored.select("owner", "filename", F.upper("key").alias("key"))
    return requests.withColumn("key", F.upper("key")).join(at, ["owner", "filename", "key"], "left_anti")
