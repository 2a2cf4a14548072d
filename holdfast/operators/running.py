"""Running values over long ordered histories, split so that no key fills one task.

A plain window puts all rows of a key into one task. Here the unique arrival number cuts the
history into blocks of at most ``block_rows`` rows. Each (key, block) is reduced on its own, the
much shorter list of blocks gets the running value, and every row starts from its block's value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1_000_000


def block_of(seq: str, block_rows: int) -> Column:
    return F.floor(F.col(seq) / block_rows).cast("bigint")


def _earlier(key: str) -> Window:
    return Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)


def _inside(key: str, seq: str) -> Window:
    return Window.partitionBy(key, "_block").orderBy(seq)


def number_rows(df: DataFrame, key: str, seq: str, name: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``row_number`` per key in arrival order."""
    blocked = df.withColumn("_block", block_of(seq, block_rows))
    starts = (
        blocked.groupBy(key, "_block")
        .agg(F.count("*").alias("_rows"))
        .select(key, "_block", F.coalesce(F.sum("_rows").over(_earlier(key)), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(_inside(key, seq))
    return blocked.join(starts, [key, "_block"]).withColumn(name, F.col("_start") + inside).drop("_block", "_start")


def newer_only(df: DataFrame, key: str, seq: str, value: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Versioned upsert: a row is accepted if its value exceeds every earlier one of its key.

    Adds ``accepted`` and ``version``, the number of rows accepted so far.
    """
    blocked = df.withColumn("_block", block_of(seq, block_rows))
    maxima = (
        blocked.groupBy(key, "_block")
        .agg(F.max(value).alias("_max"))
        .select(key, "_block", F.max("_max").over(_earlier(key)).alias("_known"))
    )
    inside = _inside(key, seq)
    before = F.greatest(F.col("_known"), F.max(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    judged = blocked.join(maxima, [key, "_block"]).withColumn("_before", before).withColumn(
        "accepted", F.col("_before").isNull() | (F.col(value) > F.col("_before"))
    )
    counts = (
        judged.groupBy(key, "_block")
        .agg(F.count_if("accepted").alias("_taken"))
        .select(key, "_block", F.coalesce(F.sum("_taken").over(_earlier(key)), F.lit(0)).alias("_start"))
    )
    numbered = judged.join(counts, [key, "_block"])
    version = F.col("_start") + F.sum(F.col("accepted").cast("bigint")).over(inside)
    return numbered.withColumn("version", version).drop("_block", "_known", "_before", "_start")


def latest_version(writes: DataFrame, key: str, seq: str, value: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """What is stored after all writes: the newest accepted row of each key, by plain reduction."""
    accepted = newer_only(writes, key, seq, value, block_rows).where("accepted")
    return accepted.groupBy(key).agg(
        F.max("version").alias("version"), F.max(value).alias(value), F.max_by(seq, "version").alias(seq)
    )


def first_per_key(df: DataFrame, key: str, seq: str) -> DataFrame:
    """Status 1 for the first row of each key and 0 for later ones.

    The keys are reduced map-side; the first rows are then found by their unique arrival number, so no key fills a task.
    """
    firsts = df.groupBy(key).agg(F.min(seq).alias(seq)).select(seq, F.lit(1).cast("bigint").alias("_first"))
    return df.join(firsts, seq, "left").select(*df.columns, F.coalesce("_first", F.lit(0).cast("bigint")).alias("status"))
