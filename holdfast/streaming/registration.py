"""Registration as a running service: the first request of each node succeeds, later ones do not."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_MARKED = "node bigint, seq bigint, candidate boolean"
_MARKED_ARROW = pa.schema([("node", pa.int64()), ("seq", pa.int64()), ("candidate", pa.bool_())])
_OUT = "seq bigint, node bigint, status bigint"


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Only the earliest request of a node in a task can be its first one; the others are settled here.

    A request that was the earliest so far is held back until the task has seen all of its rows.
    """
    earliest: dict[int, int] = {}
    for batch in batches:
        rows = batch.to_pandas()
        known = rows["node"].map(earliest)
        least = rows.groupby("node")["seq"].transform("min")
        best = rows["seq"].eq(least) & ~(known <= rows["seq"])
        moved = rows[best]
        beaten = [(n, earliest[n]) for n in moved["node"] if n in earliest]
        earliest.update(zip(moved["node"].tolist(), moved["seq"].tolist(), strict=True))
        settled = pd.concat([rows[~best], pd.DataFrame(beaten, columns=["node", "seq"], dtype="int64")])
        yield _batch(settled["node"], settled["seq"], False)
    yield _batch(list(earliest), list(earliest.values()), True)


def _batch(nodes, seqs, candidate: bool) -> pa.RecordBatch:
    nodes = pa.array(nodes, pa.int64())
    return pa.RecordBatch.from_arrays([nodes, pa.array(seqs, pa.int64()), pa.array([candidate] * len(nodes), pa.bool_())], schema=_MARKED_ARROW)


def _first(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    seqs = pd.concat(list(batches))["seq"].sort_values()
    status = pd.Series(0, index=range(len(seqs)))
    if not state.exists:
        status.iloc[0] = 1
        state.update((int(seqs.iloc[0]),))
    yield pd.DataFrame({"seq": seqs.to_numpy(), "node": int(key[0]), "status": status.to_numpy()})


def register(requests: DataFrame) -> DataFrame:
    """Status 1 for the first request of each node and 0 for later ones: ``seq, node, status`` for every row.

    ``requests`` has a unique arrival number ``seq`` and ``node``, in order of ``seq`` across batches. State is
    one number for each node ever seen. A node with a third of all requests sends one row a task to its state.
    """
    marked = requests.select("node", "seq").mapInArrow(_mark, _MARKED)
    settled = marked.where("not candidate").select("seq", "node", F.lit(0).cast("bigint").alias("status"))
    asked = marked.where("candidate").select("node", "seq")
    judged = asked.groupBy("node").applyInPandasWithState(_first, _OUT, "first bigint", "append", GroupStateTimeout.NoTimeout)
    return settled.unionByName(judged)
