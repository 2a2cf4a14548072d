"""Deterministic ranks: metric first, then the code, so ties never depend on execution order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows with their rank. Only those ``k`` rows ever meet in one task."""
    first = df.orderBy(*order).limit(k)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def top_k_per_group(df: DataFrame, group: str | list[str], k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each group; Spark prunes to ``k`` per task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= k)


def ranked_within(df: DataFrame, group: str, *order: Column) -> DataFrame:
    """All rows numbered inside their group; for groups of reduced rows (airports, time buckets)."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("rank", rank.cast("bigint"))
