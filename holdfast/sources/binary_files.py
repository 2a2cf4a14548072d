"""Whole files as rows, and the stored chunk table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every file below ``path``: path, modificationTime, length, content."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


FILE_BYTES = 64 << 20


def write_lines(texts: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Text rows as files, each row ended by a newline; a file has ``file_bytes`` at most, or a single row.

    Rows are written in three classes by size, each with as many rows a file as its longest row allows.
    """
    name = texts.columns[0]
    size = F.coalesce(F.octet_length(name), F.lit(0)) + 1
    sized = [(10_000, size <= file_bytes // 10_000), (100, (size > file_bytes // 10_000) & (size <= file_bytes // 100)), (1, size > file_bytes // 100)]
    for rows, here in sized:
        texts.where(here).write.mode("append").option("maxRecordsPerFile", rows).text(path)


def lines(files: DataFrame) -> DataFrame:
    """The newline-ended lines of files read as bytes; an empty file has none."""
    body = F.decode("content", "UTF-8")
    whole = files.where("length > 0")
    return whole.select(F.explode(F.split(body.substr(F.lit(1), F.length(body) - 1), "\n")).alias("line"))


BUCKET_KEY = ["filename", "chunk_no"]


def write_bucketed(rows: DataFrame, path: str, buckets: int, keys: list[str] = BUCKET_KEY, writers: int = 1) -> DataFrame:
    """``rows`` as a table in ``buckets`` of a hash of ``keys``; the table, which joins on ``keys`` without a shuffle.

    Two tables with the same keys and number of buckets are co-located. Each of the ``writers`` of a bucket is
    a task of its own, addressed by number, so tasks are as even as the hash. Another session finds the table
    again with ``open_bucketed``.
    """
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))  # the hash that a shuffle by these keys uses
    writer = F.pmod(F.xxhash64(*rows.columns[:3]), F.lit(writers)).cast("int")
    placed = rows.repartitionById(buckets * writers, (bucket * writers + writer).cast("int"))
    name = f"bucketed_{uuid.uuid4().hex}"
    placed.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)


def open_bucketed(spark: SparkSession, path: str, buckets: int, keys: list[str] = BUCKET_KEY) -> DataFrame:
    """A table that ``write_bucketed`` left at ``path``."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    listed = ", ".join(keys)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def write_chunk_table(chunks: DataFrame, manifest: DataFrame, path: str, buckets: int = 16) -> None:
    """Chunk bytes and their manifest as two tables in the same buckets of file name and chunk number.

    Hashing the chunk number too spreads one huge file over all buckets. The session's shuffle
    partitions are shared out over the buckets of the bytes, so each task writes one file of one bucket.
    """
    tasks = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    write_bucketed(chunks.select("filename", "chunk_no", "data"), f"{path}/data", buckets, writers=max(1, -(-tasks // buckets)))
    write_bucketed(manifest, f"{path}/meta", buckets)


def read_chunk_table(spark: SparkSession, path: str, buckets: int = 16) -> tuple[DataFrame, DataFrame]:
    return open_bucketed(spark, f"{path}/data", buckets), open_bucketed(spark, f"{path}/meta", buckets)
