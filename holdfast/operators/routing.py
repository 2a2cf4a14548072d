"""Routing tables of the key ring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions import ring as rx


def routing_table(peers: DataFrame) -> DataFrame:
    """Row i, prefix of i+1 digits: the best peer sharing i digits and differing in the next.

    The peers of one prefix lie side by side on the ring, so seen from outside the nearest is the
    first or the last of them. Only those two are looked at: at most 60 cells per peer, not all
    pairs of peers.
    """
    ids = peers.select("id", rx.to_int(F.col("id")).alias("peer"))
    rows = F.explode(F.array(*[F.lit(i) for i in range(rx.DIGITS)]))
    placed = ids.select("id", "peer", rows.alias("row_no"))
    parent = F.col("id").substr(F.lit(1), F.col("row_no"))
    groups = (
        placed.groupBy("row_no", F.col("id").substr(F.lit(1), F.col("row_no") + 1).alias("prefix"))
        .agg(F.min("peer").alias("first"), F.max("peer").alias("last"))
        .withColumn("parent", F.col("prefix").substr(F.lit(1), F.col("row_no")))
    )
    own = F.col("id").substr(F.lit(1), F.col("row_no") + 1)
    cells = placed.withColumn("parent", parent).join(groups, ["row_no", "parent"]).where(own != F.col("prefix"))
    return cells.select(
        "peer", "row_no", "prefix", rx.nearer(F.col("peer"), F.col("first"), F.col("last")).alias("target")
    )
