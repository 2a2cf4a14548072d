"""User code at the two places a job may want it: a mapper over lines and a reducer over the values of a key.

Column expressions come first; this is for code that they cannot say. A combiner is the ``merge`` of a
``StateAggregate``: its partial states are made where the rows are and only they are shuffled.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.conversion import ArrowTableToRowsConversion, LocalDataToArrowConversion

#: Rows of reducers that a task holds before it hands them on.
OUT_ROWS = 10_000

#: Keys whose partial states a task holds before it hands them on.
HELD_KEYS = 100_000


class Mapper(Protocol):
    def map(self, line: str) -> Iterable[tuple]:
        """Zero or more output rows for a line."""


class Reducer(Protocol):
    """Made anew for every key (set-up), then given its rows one by one, then asked for output rows (clean-up)."""

    def reduce(self, row: Any) -> None: ...

    def finish(self) -> Iterable[tuple]: ...


class StateAggregate(Protocol):
    """A state small enough for one row; ``merge`` must not mind the order or the grouping of states."""

    def zero(self) -> Any: ...

    def update(self, state: Any, rows: pa.RecordBatch) -> Any:
        """The state after more rows of its key, given without the key column."""

    def merge(self, left: Any, right: Any) -> Any: ...

    def finish(self, state: Any) -> tuple: ...


def map_lines(lines: DataFrame, mapper: type[Mapper], ddl: str, line: str = "line") -> DataFrame:
    """All rows the mapper makes of all lines, as columns ``ddl``. Runs where the lines are, in Arrow batches; no shuffle.

    One mapper is made for each task. Null lines are skipped. The rows of a line travel together, as one array.
    """
    made: list[Mapper] = []

    def map_line(text):
        if text is None:
            return []
        if not made:
            made.append(mapper())
        return list(made[0].map(text))

    rows = F.udf(map_line, T.ArrayType(T.StructType.fromDDL(ddl)), useArrow=True)
    return lines.select(F.inline(rows(F.col(line))))


def reduce_rows(rows: DataFrame, key: str, reducer: type[Reducer], ddl: str, order: str | None = None) -> DataFrame:
    """What the reducer makes of the rows of each ``key``, given one after the other, in ``order`` if it is named.

    The rows of a key stream through one reducer, which holds only what it wants to; they reach it in Arrow
    batches, sorted by Spark. A key with very many rows keeps its task busy; code that can be split should be
    a ``StateAggregate``.
    """
    given, made, at = rows.schema, T.StructType.fromDDL(ddl), rows.columns.index(key)

    def reduce_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, current, out = None, None, []
        for batch in batches:
            for row in ArrowTableToRowsConversion.convert(pa.Table.from_batches([batch]), given):
                if current is None or row[at] != here:
                    if current is not None:
                        out.extend(current.finish() or [])
                    here, current = row[at], reducer()
                current.reduce(row)
                if len(out) >= OUT_ROWS:
                    yield from LocalDataToArrowConversion.convert(out, made, False).to_batches()
                    out = []
        if current is not None:
            out.extend(current.finish() or [])
        if out:
            yield from LocalDataToArrowConversion.convert(out, made, False).to_batches()

    together = rows.repartition(F.col(key)).sortWithinPartitions(key, *([order] if order else []))
    return together.mapInArrow(reduce_keys, made)


def aggregate(rows: DataFrame, key: str, user: StateAggregate, ddl: str, held_keys: int = HELD_KEYS) -> DataFrame:
    """``key`` and the columns ``ddl``: the user's aggregate of each key's rows; null keys are one key.

    Tasks fold their own rows into states first, vector by vector, and hand on at most one state a key for every
    ``held_keys`` different keys. States are then merged, so a key with a third of all rows shuffles one row a task.
    """
    key_type = rows.schema[key].dataType.simpleString()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict = {}

        def hand_on():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(states), key_arrow), pa.array([pickle.dumps(s) for s in states.values()], pa.binary())], names=["key", "state"])

        key_arrow = pa.null()
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0)
            key_arrow = keys.type
            coded = keys.dictionary_encode(null_encoding="encode")
            codes = coded.indices.to_numpy()
            order = np.argsort(codes, kind="stable")
            values = batch.select(batch.schema.names[1:]).take(pa.array(order))
            starts = np.flatnonzero(np.append(True, np.diff(codes[order]) != 0))
            names = coded.dictionary.to_pylist()
            for start, stop in zip(starts, np.append(starts[1:], len(order)), strict=True):
                name = names[codes[order[start]]]
                states[name] = user.update(states[name] if name in states else user.zero(), values.slice(start, stop - start))
            if len(states) >= held_keys:
                yield hand_on()
                states.clear()
        if states:
            yield hand_on()

    def merge(table: pa.Table) -> pa.Table:
        states = [pickle.loads(s) for s in table.column("state").to_pylist()]
        whole = states[0]
        for state in states[1:]:
            whole = user.merge(whole, state)
        row = user.finish(whole)
        return pa.Table.from_arrays([table.column("key").slice(0, 1), *(pa.array([v]) for v in row)], names=[key, *names])

    parts = rows.select(F.col(key), *[c for c in rows.columns if c != key]).mapInArrow(partial, f"key {key_type}, state binary")
    names = [part.strip().split(" ")[0] for part in ddl.split(",")]
    return parts.groupBy("key").applyInArrow(merge, f"`{key}` {key_type}, {ddl}")
