"""Node heartbeats as a stream: state per node and live intervals.

A heartbeat row has ``node, seq, ts, kind, entry, free_space``; ``ts`` is the event time. Only the
live intervals have a watermark; rows later than it allows can be kept apart before (``feeds.split_late``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

LATENESS = "1 hour"
#: Shares that the nodes are divided into; those of a share have one state together.
SHARES = 1024

_REDUCED = "node bigint, restart bigint, seqs array<bigint>, entries array<bigint>, free_space bigint"
_REDUCED_ARROW = pa.schema([("node", pa.int64()), ("restart", pa.int64()), ("seqs", pa.list_(pa.int64())),
                            ("entries", pa.list_(pa.int64())), ("free_space", pa.int64())])
_STATE = "nodes array<bigint>, restarts array<bigint>, counts array<bigint>, seqs array<bigint>, entries array<bigint>, free_spaces array<bigint>"
_OUT = "node bigint, seq bigint, free_space bigint, entries array<bigint>"


def _since_major(rows: pd.DataFrame) -> pd.DataFrame:
    """The reports that still count: the last major one of each node and everything after it."""
    major = rows["seq"].where(rows["kind"] == "major").groupby(rows["node"]).transform("max")
    return rows[~(rows["seq"] < major)]


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each node from all reports of a task; newest report first."""
    held: pd.DataFrame | None = None
    for batch in batches:
        rows = batch.to_pandas()
        held = _since_major(rows if held is None else pd.concat([held, rows]))
    if held is None or held.empty:
        return
    held = held.sort_values(["node", "seq"], ascending=[True, False])
    first = ~held["node"].duplicated()
    ends = np.append(np.flatnonzero(first), len(held)).astype(np.int32)
    restart = held["seq"].where(held["kind"] == "major", -1).groupby(held["node"], sort=True).max()
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(held[c].astype("int64"))) for c in ("seq", "entry")]
    heads = held[first]
    yield pa.RecordBatch.from_arrays(
        [pa.array(heads["node"].astype("int64")), pa.array(restart.astype("int64").to_numpy()), *lists, pa.array(heads["free_space"].astype("int64"))],
        schema=_REDUCED_ARROW)


def merge_summaries(parts: Iterable[tuple]) -> tuple[int, list[int], list[int], int]:
    """One summary for several of the same node, whatever their order: ``(restart, seqs, entries, free_space)``.

    ``restart`` is the last major report (-1: none); reports from it on are listed newest first, with the newest one's space.
    """
    parts = list(parts)
    restart = max(part[0] for part in parts)
    kept = sorted({(s, e) for part in parts for s, e in zip(part[1], part[2], strict=True) if s >= restart}, reverse=True)
    newest = max(parts, key=lambda part: part[1][0])
    return int(restart), [int(s) for s, _ in kept], [int(e) for _, e in kept], int(newest[3])


def _held(state: GroupState) -> dict[int, tuple]:
    """The summaries of a share's nodes."""
    if not state.exists:
        return {}
    nodes, restarts, counts, seqs, entries, spaces = state.get
    ends = list(accumulate(counts))
    return {node: (restart, seqs[end - n:end], entries[end - n:end], free)
            for node, restart, n, end, free in zip(nodes, restarts, counts, ends, spaces, strict=True)}


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A major report replaces the node's entries, a minor one puts its entry before them; one call for all nodes of a share."""
    held, new = _held(state), {}
    for rows in batches:
        for node, *part in zip(*(rows[c].tolist() for c in ("node", "restart", "seqs", "entries", "free_space")), strict=True):
            new.setdefault(node, []).append(part)
    for node, parts in new.items():
        held[node] = merge_summaries([*parts, *([held[node]] if node in held else [])])
    every = list(held.values())
    state.update((list(held), [p[0] for p in every], [len(p[1]) for p in every],
                  [s for p in every for s in p[1]], [e for p in every for e in p[2]], [p[3] for p in every]))
    told = [held[node] for node in new]
    yield pd.DataFrame({"node": list(new), "seq": [p[1][0] for p in told], "free_space": [p[3] for p in told], "entries": [p[2] for p in told]})


def reduce_reports(heartbeats: DataFrame) -> DataFrame:
    """What each task's reports come to, one row for each node and task; tasks hold what still counts of their nodes."""
    return heartbeats.select("node", "seq", "kind", "entry", "free_space").mapInArrow(_reduce, _REDUCED)


def fold_reports(heartbeats: DataFrame, shares: int = SHARES) -> DataFrame:
    """The state of each node after each batch that touched it.

    Reports are reduced in each task first, so a node with a third of all reports sends one row a task. Summaries
    merge in any order. Nodes are folded by shares, many in one call; state is one row per share, and a node's list
    in it restarts with every major report.
    """
    share = F.pmod(F.xxhash64("node"), F.lit(shares)).cast("int")
    return reduce_reports(heartbeats).withColumn("share", share).groupBy("share").applyInPandasWithState(
        _fold, _OUT, _STATE, "append", GroupStateTimeout.NoTimeout
    )


def latest_reports(heartbeats: DataFrame) -> DataFrame:
    """The last report of each node so far, for an update stream; no report is too late to count.

    State is one row per node, and tasks reduce what they read before it is sent on.
    """
    return heartbeats.groupBy("node").agg(F.max("seq").alias("seq"), F.max_by("free_space", "seq").alias("free_space"))


def live_intervals(heartbeats: DataFrame, timeout: str, delay: str = LATENESS) -> DataFrame:
    """Intervals in which a node kept reporting; the end is when it is declared dead.

    Reports more than ``delay`` behind the newest may be left out; ``feeds.split_late`` with the same delay
    keeps them in a table of their own, and none of the others is left out then. Rows without a node are ticks
    of the prober's clock: they move the time on, but belong to no interval.
    """
    timed = heartbeats.withWatermark("ts", delay)
    timed = timed.where("node is not null or ts is null")  # with the time in it, so that ticks are left out behind the watermark only
    return timed.groupBy(F.session_window("ts", timeout).alias("live"), "node").agg(
        F.count("*").alias("reports")
    ).select("node", F.col("live.start").alias("live_from"), F.col("live.end").alias("dead_at"), "reports")


def latest_state(written: DataFrame, *columns: str) -> DataFrame:
    """The newest row of each node among everything a stream has written."""
    values = F.max_by(F.struct(*columns), "seq").alias("last")
    return written.groupBy("node").agg(values).select("node", *[F.col(f"last.{c}").alias(c) for c in columns])


def clock_tick(heartbeats: DataFrame, after: str) -> DataFrame:
    """A tick of the clock, a row without a node, far enough behind the reports to let their intervals end."""
    end = heartbeats.agg(F.max("seq").alias("seq"), F.max("ts").alias("ts"))
    moved = (F.col("ts") + F.expr(f"INTERVAL {after}")).alias("ts")
    rest = [F.lit(None).cast(t).alias(c) for c, t in heartbeats.dtypes if c not in ("seq", "ts")]
    return end.select((F.col("seq") + 1).alias("seq"), moved, *rest).select(*heartbeats.columns)


@contextmanager
def sessions_merged_early(spark: SparkSession) -> Iterator[None]:
    """Merge sessions inside each task before the shuffle, so a chatty node sends few rows."""
    name = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
