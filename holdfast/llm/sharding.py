"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows lie in source blocks. How many rows of each block go to each shard is drawn first, from the law
those counts have under a uniform permutation with fixed shard sizes. Each block then permutes its rows
and deals them out by its row of the matrix, and each shard permutes what it got. All steps are
DataFrame operations; the driver holds block counts and the matrix, no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.common import query, table
from holdfast.session import staged

BLOCK_ROWS = 1_000
MOST_BLOCKS = 4_096
PART_ROWS = 250_000


def communication_matrix(block_rows: list[int], shard_rows: list[int], seed: int) -> list[list[int]]:
    """Counts by block and shard with these margins, distributed as under a uniform permutation."""
    import numpy as np

    rng = np.random.default_rng(seed)
    left = np.array(shard_rows, dtype=np.int64)
    matrix = []
    for rows in block_rows:
        drawn = rng.multivariate_hypergeometric(left, rows, method="marginals") if rows else np.zeros_like(left)
        left = left - drawn
        matrix.append(drawn.tolist())
    return matrix


def _ordered(seed: int, columns: list[str]):
    return F.xxhash64(F.lit(seed), *columns)


def _begins(rows: DataFrame, whole: str, part: str, parts: int) -> DataFrame:
    """``rows`` with ``start``: how many rows of the same ``whole`` lie in the parts before."""
    if parts == 1:
        return rows.withColumn("start", F.lit(0))
    before = Window.partitionBy(whole).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(whole, part).count().select(whole, part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    return rows.join(starts, [whole, part])


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 17, block_rows: int = BLOCK_ROWS, part_rows: int = PART_ROWS,
                        most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """``df`` with ``shard`` (from 0) and ``slot`` (from 0, gapless in its shard); sizes differ by at most one.

    Every assignment of rows to slots is equally likely over seeds; a seed always gives the same one, also
    when tasks run again, because order comes from hashes of whole rows. Rows equal in every column are
    interchangeable. Columns named ``shard`` or ``slot`` in ``df`` are replaced; map columns are not supported.
    Null values are allowed anywhere. An empty ``df`` gives no rows.

    The matrix has at most ``most_blocks`` rows. Beyond ``most_blocks * block_rows`` rows a block is permuted in cuts
    of about ``block_rows``, and a shard always in parts of about ``part_rows``, each a range of the random order;
    counts of the cuts and parts before say where each begins. So tasks keep their size and become more.
    """
    spark = df.sparkSession
    columns = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("r"))
    whole = ["r"]
    total = rows.count()
    blocks = max(1, min(most_blocks, -(-total // block_rows)))
    cuts = max(1, -(-total // (blocks * block_rows)))
    parts = max(1, -(-total // (shards * part_rows)))
    placed = rows.withColumn("block", F.pmod(_ordered(seed, whole), F.lit(blocks)).cast("int"))
    counted = {x.block: x["count"] for x in placed.groupBy("block").count().collect()}
    counts = [counted.get(b, 0) for b in range(blocks)]
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    until = []
    for drawn in communication_matrix(counts, sizes, seed):
        reached, line = 0, []
        for n in drawn:
            reached += n
            line.append(reached)
        until.append(line)
    matrix = F.from_json(F.lit(json.dumps(until)), "array<array<bigint>>")
    in_cut = Window.partitionBy("block", "cut").orderBy(_ordered(seed + 1, whole))
    cut = placed.withColumn("cut", F.pmod(_ordered(seed + 4, whole), F.lit(cuts)).cast("int")) if cuts > 1 else placed.withColumn("cut", F.lit(0))
    dealt = _begins(cut, "block", "cut", cuts).withColumn("n", F.col("start") + F.row_number().over(in_cut) - 1).select(
        "r",
        F.size(F.filter(F.get(matrix, F.col("block")), lambda end: end <= F.col("n"))).alias("shard"),
        F.pmod(_ordered(seed + 2, whole), F.lit(parts)).cast("int").alias("part"),
    )
    in_part = Window.partitionBy("shard", "part").orderBy(_ordered(seed + 3, whole))
    dealt = _begins(staged(dealt, "dealt") if parts > 1 else dealt, "shard", "part", parts)
    return dealt.select("r", "shard", (F.col("start") + F.row_number().over(in_part) - 1).cast("long").alias("slot")).select(
        *[F.col(f"r.`{c}`") for c in columns], "shard", "slot")


@query("op6_shard_shuffle")
def op6_shard_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    digests = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    return shuffle_into_shards(digests, 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
