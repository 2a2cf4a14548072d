"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.session import drop_path, fresh_path


def _write(df: DataFrame) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = fresh_path(spark, "edges")
    df.write.parquet(path)
    return spark.read.schema("u long, v long").parquet(path), path


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(2**40))).alias("s")).first()
    return (row.n, row.s)


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star step and one small-star step; ``u > v`` in every row that goes in or comes out."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    large = (
        both.join(least, "u").where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )
    floor = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(floor, "u").select(
        F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    return small.where("u > v").distinct()


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its smallest node.

    Links are columns ``a`` and ``b`` (bigint), in any order and any number. Each step is written to
    the shared folder and the one before it removed; the driver sees one count and one sum a step.
    Steps grow with the logarithm of the number of nodes. Missing ends and loops are left out.
    """
    pairs = (
        edges.select(F.col(a).cast("long").alias("p"), F.col(b).cast("long").alias("q")).where("p <> q")
        .select(F.greatest("p", "q").alias("u"), F.least("p", "q").alias("v")).distinct()
    )
    now, path = _write(pairs)
    seen = _signature(now)
    while True:
        then, old = now, path
        now, path = _write(_stars(then))
        drop_path(now.sparkSession, old)
        after = _signature(now)
        if after == seen:
            break
        seen = after
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
