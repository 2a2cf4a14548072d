"""Key-ring tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions import ring as rx
from holdfast.operators import ring
from holdfast.session import staged
from holdfast.sources.tables import table


def _peer_id(number: str) -> Column:
    name = F.concat(F.lit("peer-"), F.col(number).cast("string")).cast("binary")
    return F.upper(F.substring(F.sha1(name), 1, 4))


def registrations(spark: SparkSession, sf: str) -> DataFrame:
    """Requests for an identifier in arrival order; some ask for the same one."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("seq"), _peer_id("c_custkey").alias("id"), F.col("c_name").alias("nickname")
    )


def peers(spark: SparkSession, sf: str) -> DataFrame:
    """Registered peers, at most 65,536, written down once because every ring job reads them often."""
    asked = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("seq"), _peer_id("s_suppkey").alias("id"), F.col("s_name").alias("nickname"),
        F.concat(F.lit("host"), F.col("s_nationkey").cast("string")).alias("host"),
        (5000 + F.col("s_suppkey")).alias("port"),
    )
    return staged(ring.register(asked), "peers")


def newest(peers: DataFrame) -> Column:
    return peers.agg(F.max("seq")).scalar()


def stored_files(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))
    return table(spark, sf, "documents").select("doc_id", name.alias("filename")).withColumn("key", rx.key_of(F.col("filename")))


def read_requests(spark: SparkSession, sf: str) -> DataFrame:
    """One read per document: some with a wrong key, some with a wrong name, keys in lower case."""
    files = stored_files(spark, sf)
    return files.select(
        F.col("doc_id").alias("request"),
        F.when(F.col("doc_id") % 7 == 0, F.concat("filename", F.lit("?"))).otherwise(F.col("filename")).alias("filename"),
        F.when(F.col("doc_id") % 5 == 0, F.reverse("key")).otherwise(F.lower("key")).alias("key"),
    )


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of identifiers; a quarter are equal and a quarter half a ring apart."""
    e = F.col("event_id")
    a = F.pmod(e * 40503, F.lit(rx.SPACE))
    shift = F.when(e % 4 == 0, 0).when(e % 4 == 1, rx.HALF).when(e % 4 == 2, e % 17).otherwise(F.col("user_id") * 7919)
    return table(spark, sf, "events").select(
        e.alias("pair"), a.cast("int").alias("a"), F.pmod(a + shift, F.lit(rx.SPACE)).cast("int").alias("b")
    )
