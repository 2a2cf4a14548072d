"""Files of any size as chunk rows, read by byte ranges: no row and no task ever holds a whole file.

``spark.dataSource.register(ChunkSource)`` makes the format ``chunks`` known; ``read_chunks`` does both.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

CHUNK_BYTES = 65_536
RANGE_BYTES = 128 << 20
BATCH_BYTES = 8 << 20

SCHEMA = "path string, file_bytes bigint, chunk_no bigint, data binary"
_ARROW = pa.schema([("path", pa.string()), ("file_bytes", pa.int64()), ("chunk_no", pa.int64()), ("data", pa.binary())])


def _store(path: str):
    """The file system of ``path`` and the path in it; anything Arrow can open by its address."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


@dataclass
class Ranges(InputPartition):
    """Byte ranges for one task: ``(path, file_bytes, start, stop)``, each starting at a chunk."""

    parts: list[tuple[str, int, int, int]]


def cut_ranges(files: list[tuple[str, int]], chunk_bytes: int, range_bytes: int) -> Iterator[Ranges]:
    """Ranges of at most ``range_bytes`` (one chunk at least), small files together up to that many bytes."""
    step = max(1, range_bytes // chunk_bytes) * chunk_bytes
    held, size = [], 0
    for path, file_bytes in files:
        for start in range(0, file_bytes, step):
            stop = min(start + step, file_bytes)
            if held and size + stop - start > step:
                yield Ranges(held)
                held, size = [], 0
            held.append((path, file_bytes, start, stop))
            size += stop - start
    if held:
        yield Ranges(held)


def share_out(ranges: Iterable[Ranges], task_bytes: int) -> Iterator[Ranges]:
    """The same ranges, as many to a task as have ``task_bytes`` together (one ``Ranges`` at least)."""
    held, size = [], 0
    for one in ranges:
        more = sum(stop - start for _, _, start, stop in one.parts)
        if held and size + more > task_bytes:
            yield Ranges(held)
            held, size = [], 0
        held.extend(one.parts)
        size += more
    if held:
        yield Ranges(held)


class _Reader(DataSourceReader):
    def __init__(self, path: str, chunk_bytes: int, range_bytes: int, tasks: int = 0):
        self.path, self.chunk_bytes, self.range_bytes, self.tasks = path, chunk_bytes, range_bytes, tasks

    def partitions(self) -> list[Ranges]:
        """Files below the path that are not hidden, nor in a hidden folder; the list names files, their bytes stay where they are."""
        from pyarrow import fs

        store, root = _store(self.path)
        top = store.get_file_info(root)
        if top.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True)) if top.type == fs.FileType.Directory else [top]
        shown = lambda path: not any(name[:1] in ("_", ".") for name in path.removeprefix(root).split("/"))
        files = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and (f is top or shown(f.path)))
        ranges = cut_ranges(files, self.chunk_bytes, self.range_bytes)
        if self.tasks:
            ranges = share_out(ranges, min(RANGE_BYTES, -(-sum(size for _, size in files) // self.tasks)))
        return list(ranges) or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        at_once = max(1, BATCH_BYTES // self.chunk_bytes)
        for path, file_bytes, start, stop in partition.parts:
            with store.open_input_file(path) as file:
                while start < stop:
                    size = min(at_once * self.chunk_bytes, stop - start)
                    body = file.read_at(size, start)
                    if len(body) != size:
                        raise OSError(f"{path} has changed: {size} bytes expected at {start}, {len(body)} found")
                    pieces = [body[i:i + self.chunk_bytes] for i in range(0, size, self.chunk_bytes)]
                    first, n = start // self.chunk_bytes, len(pieces)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * n), pa.array([file_bytes] * n, pa.int64()), pa.array(range(first, first + n), pa.int64()), pa.array(pieces, pa.binary())],
                        schema=_ARROW)
                    start += size


class ChunkSource(DataSource):
    """``spark.read.format("chunks")`` with ``path`` and, in bytes, ``chunkBytes`` and ``rangeBytes``; ``tasks`` as in ``read_chunks``."""

    @classmethod
    def name(cls) -> str:
        return "chunks"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], int(self.options.get("chunkBytes", CHUNK_BYTES)), int(self.options.get("rangeBytes", RANGE_BYTES)),
                       int(self.options.get("tasks", 0)))


def read_chunks(
    spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, range_bytes: int = RANGE_BYTES, tasks: int = 0,
) -> DataFrame:
    """``path, file_bytes, chunk_no, data`` for every chunk of every file below ``path``; empty files have none.

    A task reads ranges of ``range_bytes`` in batches of ``BATCH_BYTES``. The path may be on any store Arrow opens.
    With ``tasks``, a task takes several ranges one after the other: about that many tasks, or more if one would
    have over ``RANGE_BYTES`` in all.
    """
    spark.dataSource.register(ChunkSource)
    options = {"chunkBytes": chunk_bytes, "rangeBytes": range_bytes, "tasks": tasks}
    return spark.read.format("chunks").options(**options).load(path)
