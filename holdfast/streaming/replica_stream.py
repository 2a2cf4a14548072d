"""Replica lists kept up to date from a stream of raw events, deaths of nodes included.

Two stateful steps follow one another. The first knows, per node, the chunks it was named on since it last
died, and turns a death into one event for each of them. The second knows the list of every chunk. Between
them the events of a chunk are summarised in blocks on many tasks, so a busy chunk costs its state step one
row a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from holdfast.operators import replica_lists
from holdfast.operators.running import BLOCK_ROWS, block_of

#: Shares of a node's chunks, each with a state of its own.
SHARES = 8

_HIT = "chunk bigint, seq bigint, node bigint"
_STATE = "nodes array<bigint>, seqs array<bigint>, places array<bigint>"
_OUT = "chunk bigint, seq bigint, nodes array<bigint>"


class _Deaths(StatefulProcessor):
    """Rows without a chunk are deaths of the node; they hit every chunk named since the death before.

    Each chunk is an entry of its own in the state, so a batch touches only what it names. All deaths of a batch
    give one table of hits.
    """

    def init(self, handle) -> None:
        self.held = handle.getMapState("held", "chunk bigint", "seq bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values("seq")
        died = batch["chunk"].isna().to_numpy()
        chunks = batch["chunk"].fillna(-1).astype("int64").to_numpy()
        seqs = batch["seq"].astype("int64").to_numpy()
        deaths = np.flatnonzero(died)
        last = deaths[-1] + 1 if len(deaths) else 0
        if len(deaths):
            before = [k[0] for k in self.held.keys()]
            if before:
                self.held.clear()
            # each naming before the last death is hit by the first death after it; what is held, by the first of all
            named = np.flatnonzero(~died[:last])
            death = np.concatenate([np.zeros(len(before), np.int64), np.searchsorted(deaths, named)])
            hit = pd.DataFrame({"death": death, "chunk": np.concatenate([np.array(before, np.int64), chunks[named]])}).drop_duplicates()
            if len(hit):
                yield pd.DataFrame({"chunk": hit["chunk"].to_numpy(), "seq": seqs[deaths[hit["death"]]], "node": int(key[0])})
        for chunk in np.unique(chunks[last:]):
            self.held.updateValue((int(chunk),), (int(seqs[-1]),))

    def close(self) -> None:
        pass


@contextmanager
def map_state(spark: SparkSession) -> Iterator[None]:
    """The state store that keeps entries of maps apart; a running query holds on to the one it began with."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread_deaths(events: DataFrame, shares: int = SHARES) -> DataFrame:
    """The stream's ``dead`` events as events on the chunks they can matter to.

    Removing a node that is not listed changes nothing, so a death concerns the chunks that named the node
    since it died before. State: one entry for each of those chunks, in ``shares`` maps a node; a death empties them.
    A node with a third of all events is spread over ``shares`` tasks. Needs ``map_state``.
    """
    named = events.where("kind <> 'dead'").select("seq", "chunk", F.explode(F.array_distinct("nodes")).alias("node"))
    share = F.pmod(F.xxhash64("chunk"), F.lit(shares)).cast("int").alias("share")
    on_chunk = named.select("node", share, "seq", "chunk")
    every = F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share")
    of_node = events.where("kind = 'dead'").select(F.element_at("nodes", 1).alias("node"), every, "seq", F.lit(None).cast("bigint").alias("chunk"))
    both = on_chunk.unionByName(of_node)
    hits = both.groupBy("node", "share").transformWithStateInPandas(_Deaths(), _HIT, "append", "none")
    return hits.select("chunk", "seq", F.lit("dead").alias("kind"), F.array("node").alias("nodes"))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows of this batch, sorted and summarised; a streaming plan cannot sort for us."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held).sort_by([("chunk", "ascending"), ("block", "ascending"), ("seq", "ascending")])
    last = rows.group_by(["chunk", "block"], use_threads=False).aggregate([("seq", "max")])
    newest = {(c, b): s for c, b, s in zip(*(last.column(n).to_pylist() for n in ("chunk", "block", "seq_max")), strict=True)}
    for batch in replica_lists.summarise_runs(rows.to_batches()):
        seq = pa.array([newest[c, b] for c, b in zip(batch.column("chunk").to_pylist(), batch.column("block").to_pylist(), strict=True)], pa.int64())
        yield batch.append_column("seq", seq)


def _step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(batches)).sort_values("block")
    listed: dict[int, tuple[int, int]] = {}
    if state.exists:
        listed = {int(n): (int(s), int(p)) for n, s, p in zip(*state.get, strict=True)}
    for row in rows.itertuples(index=False):
        listed = replica_lists.apply(listed, replica_lists._unpack(row))
    nodes = replica_lists.ordered(listed)
    state.update((nodes, [listed[n][0] for n in nodes], [listed[n][1] for n in nodes]))
    yield pd.DataFrame([{"chunk": int(key[0]), "seq": int(rows["seq"].max()), "nodes": nodes}])


def follow(events: DataFrame, block_rows: int = BLOCK_ROWS, shares: int = SHARES) -> DataFrame:
    """The list of each chunk after each batch that touched it.

    ``events`` are raw: ``seq, kind, chunk, nodes``, with ``dead`` events that name a node and no chunk. Events
    have to arrive in order of ``seq`` across batches; inside a batch they are sorted. State of a chunk is its list.
    Start the query inside ``map_state``.
    """
    events = events.select("seq", "kind", "chunk", "nodes")
    on_chunk = events.where("kind <> 'dead'").select("chunk", "seq", "kind", "nodes")
    blocked = on_chunk.unionByName(spread_deaths(events, shares)).withColumn("block", block_of("seq", block_rows))
    runs = blocked.repartition("chunk", "block").select("chunk", "block", "seq", "kind", "nodes")
    summaries = runs.mapInArrow(_summaries, replica_lists.SUMMARY + ", seq bigint")
    return summaries.groupBy("chunk").applyInPandasWithState(_step, _OUT, _STATE, "append", GroupStateTimeout.NoTimeout)


def latest_lists(written: DataFrame) -> DataFrame:
    return written.groupBy("chunk").agg(F.max_by("nodes", "seq").alias("nodes"))
