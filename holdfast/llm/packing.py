"""Best-fit packing of token sequences by hierarchical residual packing.

Tasks tokenise and pack their own documents by best fit and emit the bins that are nearly full. The
others become items themselves: groups of tasks merge in a tree, and each group packs the underfull bins
it got by best fit again. Only numbers travel; tokens stay in the task that made them.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import map_rows, query, table
from holdfast.session import fresh_path

LENGTH = 2_048
VOCABULARY = "byte_bpe_50k"
SLACK = 128
FAN_IN = 8
HELD_PIECES = 1_000_000
OPEN_BINS = 20_000


@functools.lru_cache(maxsize=2)
def _encoder(vocabulary: str):
    """Token ids of a text. tiktoken reads the same vocabulary much faster than tokenizers does."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    whole = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    special = {t.content: i for i, t in whole.get_added_tokens_decoder().items() if t.special}
    fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    allowed = set(special)

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special=allowed, disallowed_special=())
        except BaseException as stuck:  # its pattern engine gives up, or panics, on very long runs
            if isinstance(stuck, (KeyboardInterrupt, SystemExit, GeneratorExit, MemoryError)):
                raise
            return whole.encode(text, add_special_tokens=False).ids

    return encode


def best_fit(sizes: list[int], length: int) -> tuple[list[int], list[int], list[int]]:
    """Best fit, largest first: the bin and the offset of each item, and the fill of each bin."""
    by_room: list[list[int]] = [[] for _ in range(length + 1)]
    rooms = 0  # bit r: some bin has r places left
    fills: list[int] = []
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[item]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            chosen, room = len(fills), length
            fills.append(0)
        bins[item], offsets[item] = chosen, fills[chosen]
        fills[chosen] += size
        left = room - size
        if left:
            by_room[left].append(chosen)
            rooms |= 1 << left
    return bins, offsets, fills


def pieces_of(n_tokens: int, length: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document: whole sequences, what is over comes first."""
    first = n_tokens % length or min(n_tokens, length)
    return [(0, first)] + [(start, length) for start in range(first, n_tokens, length)]


def _pack_locally(docs: DataFrame, length: int, vocabulary: str, held: int) -> DataFrame:
    def run(rows):
        import struct
        from zlib import crc32

        from pyspark import TaskContext

        encode = _encoder(vocabulary)
        task = TaskContext.get().partitionId()
        made = 0
        pieces: list[tuple] = []

        def packed():
            nonlocal made
            bins, offsets, fills = best_fit([p[3] for p in pieces], length)
            for piece, at, offset in zip(pieces, bins, offsets, strict=True):
                yield (*piece, (task << 32) + made + at, offset, fills[at])
            made += len(fills)
            pieces.clear()

        for doc_id, text in rows:
            ids = [*encode(text or ""), 0]
            for number, (start, size) in enumerate(pieces_of(len(ids), length)):
                raw = struct.pack(f"<{size}I", *ids[start:start + size])
                pieces.append((doc_id, number, start, size, crc32(raw)))
            if len(pieces) >= held:
                yield from packed()
        yield from packed()

    return map_rows(
        docs.select(F.col("doc_id").cast("long"), "text"),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, leaf bigint, at bigint, fill bigint", run)


def _merge(length: int, nearly: int):
    def run(rows):
        roots = rows.drop_duplicates("root")[["root", "fill"]].sort_values("root")
        names, sizes = roots.root.tolist(), roots.fill.tolist()
        bins, offsets, fills = best_fit(sizes, length)
        first: dict[int, int] = {}
        for name, at in zip(names, bins, strict=True):
            first.setdefault(at, name)
        to_root = {n: first[b] for n, b in zip(names, bins, strict=True)}
        to_offset = dict(zip(names, offsets, strict=True))
        to_fill = {n: fills[b] for n, b in zip(names, bins, strict=True)}
        going_on = {b for b in range(len(fills)) if fills[b] < nearly}
        open_ = {n: b in going_on for n, b in zip(names, bins, strict=True)}
        old = rows.root
        return rows.drop(columns="hand").assign(offset=rows.offset + old.map(to_offset), fill=old.map(to_fill), open=old.map(open_), root=old.map(to_root))

    return run


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, slack: int = SLACK, fan_in: int = FAN_IN,
         held: int = HELD_PIECES, most_open: int = OPEN_BINS) -> DataFrame:
    """One row for each piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its token ids and a closing 0; a null or empty text is the closing 0 alone. Only documents
    longer than ``length`` are cut. A task packs its pieces together, in lots of ``held``. Bins with more than
    ``slack`` free places go on to be merged, ``fan_in`` groups at a time, until one group is left. A group with
    more than ``most_open`` bins is dealt by a hash of their names to several tasks, each with bins of all fills,
    and all underfull bins go on, so no task grows with the input and no bin is closed early. Repeated rows are
    packed each. An empty table gives no rows. Sequence numbers are only names.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "pieces")
    local = _pack_locally(docs, length, vocabulary, held)
    local.write.parquet(path)
    pieces = spark.read.schema(local.schema).parquet(path)
    nearly = length - slack + 1
    state = pieces.where((F.col("at") == 0) & (F.col("fill") < nearly)).select(
        "leaf", F.col("leaf").alias("root"), F.lit(0).cast("long").alias("offset"), "fill",
        F.shiftright("leaf", 32).alias("group"), F.lit(True).alias("open"))
    schema = state.schema
    top = state.agg(F.max("group")).first()[0]
    done = None
    while top is not None:
        top //= fan_in
        step = fresh_path(spark, "bins")
        parents = state.withColumn("group", F.floor(F.col("group") / fan_in).cast("long"))
        hands = F.ceil(F.col("bins") / most_open)
        sizes = parents.groupBy("group").agg(F.count_if(F.col("leaf") == F.col("root")).alias("bins"))  # each bin is named after one of its leaves
        dealt = parents.join(sizes, "group").withColumn("hand", F.pmod(F.xxhash64(F.lit(top), "root"), hands)).drop("bins")
        dealt.groupBy("group", "hand").applyInPandas(_merge(length, nearly), schema).write.parquet(step)
        merged = spark.read.schema(schema).parquet(step)
        settled = merged if top == 0 else merged.where("not open")
        done = settled if done is None else done.unionByName(settled)
        state = merged.where("open")
        if top == 0:
            break
    if done is None:
        moved = pieces.withColumns({"root": F.col("leaf"), "offset": F.lit(0).cast("long")})
    else:
        moved = pieces.join(done.select("leaf", "root", "offset"), "leaf", "left")
    return moved.select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("root", "leaf").alias("sequence_id"),
        (F.col("at") + F.coalesce("offset", F.lit(0))).alias("offset"))


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
