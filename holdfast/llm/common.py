"""What the operators share: reading tables, folds by identifier, and mapping columns in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query of this subpackage; ``sql`` is its twin for another engine."""

    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, modulus: int) -> Column:
    """CRC-32 of the identifier's decimal text, modulo ``modulus``; a missing identifier is fold -1."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)), F.lit(-1)).cast("int")


def give_back() -> None:
    """Return freed memory to the system, where the C library can. Workers are used again, and would keep their peak."""
    import ctypes

    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "binary": pa.binary(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.strip().split(" ", 1) for part in ddl.split(","))])


def map_rows(df: DataFrame, ddl: str, fn: Callable[[Iterable[tuple]], Iterable[tuple]], chunk: int = 2_000) -> DataFrame:
    """Run ``fn`` over the rows of each task as plain tuples, in Arrow batches both ways.

    ``fn`` gets one iterator for the whole task, so it may keep state between rows; it yields
    tuples in the order of ``ddl``.
    """
    schema = arrow_schema(ddl)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

    def pack(kept: list[tuple]) -> pa.RecordBatch:
        columns = zip(*kept, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        held = 0
        for row in fn(rows(batches)):
            kept.append(row)
            held += sum(len(v) for v in row if isinstance(v, (bytes, str)))
            if len(kept) >= chunk or held >= 16 << 20:
                yield pack(kept)
                kept, held = [], 0
        if kept:
            yield pack(kept)

    return df.mapInArrow(run, ddl)
