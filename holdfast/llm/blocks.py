"""Documents packed into compressed blocks, so that whole texts are shuffled small and worked on together."""

from __future__ import annotations

import pickle

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import map_rows, utf8
from holdfast.session import fresh_path

BLOCK_BYTES = 4 << 20


def squeeze(value) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(value, protocol=5))


def unsqueeze(data: bytes):
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def write_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, extra: str | None = None) -> DataFrame:
    """``(block, n_bytes, body)`` in the shared folder; a body holds ``(doc_ids, texts as bytes, extras)``.

    A block takes rows of one task until it holds ``block_bytes`` of text; a longer document has its own.
    ``extra`` names a string column that travels along.
    """

    def run(rows):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        ids, texts, extras, held, made = [], [], [], 0, 0
        for doc_id, text, more in rows:
            data = utf8(text)
            if ids and held + len(data) > block_bytes:
                yield (task << 32) + made, held, squeeze((ids, texts, extras))
                ids, texts, extras, held, made = [], [], [], 0, made + 1
            ids.append(doc_id)
            texts.append(data)
            extras.append(more)
            held += len(data)
        if ids:
            yield (task << 32) + made, held, squeeze((ids, texts, extras))

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.col(extra) if extra else F.lit(None).cast("string").alias("extra"))
    ddl = "block bigint, n_bytes bigint, body binary"
    path = fresh_path(docs.sparkSession, "blocks")
    map_rows(rows, ddl, run, chunk=1).write.parquet(path)
    return docs.sparkSession.read.schema(ddl).parquet(path)
