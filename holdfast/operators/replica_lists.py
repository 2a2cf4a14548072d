"""The ordered list of nodes that hold a chunk, kept up to date from events.

Events on a chunk, in arrival order:

* ``store`` sets the list;
* ``corrupt`` and ``dead`` remove the node;
* ``deleted`` removes the node and, if any other is left, puts it back at the end, because it is
  being sent the chunk again;
* ``fixed`` puts the node at the end unless it is listed.

A run of events is summarised without knowing the list it will meet, and two neighbouring summaries
compose into one, so a chunk with any number of events is folded in pieces, in a tree of tasks.

A summary stays as small as the nodes it names. After a ``store`` everything is known. Before one, the only
thing a run cannot know is which nodes were listed, and it needs that for one kind of question: "was a node
listed that the run had not yet named?" Number the nodes as the run first names them; the question asked
when ``t`` nodes had been named is "was any listed node not among the first t?", so the number ``t`` says it
all, and the answer for every ``t`` follows from the largest number among the listed nodes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.operators.running import BLOCK_ROWS, block_of

#: Summaries that one task composes at each level of the tree.
FAN = 16

# Whether a named node is listed after the run: never, always, or if the run's open question is answered yes.
NEVER, ALWAYS, ASKED = 0, 1, 2
# When its first place counts and not its second: always, if it was listed before (its place then), or a question's t.
ANYWAY, AS_BEFORE = -1, -2
_UNNAMED = 1 << 62


class Run:
    """Summary of consecutive events on one chunk, added in arrival order.

    ``start`` is the list itself, node to place, once a ``store`` was seen; else ``index`` numbers the named
    nodes and ``rule`` and ``place`` say what becomes of each. A place is ``(when, first, second)``, in arrival
    numbers. Nodes that are asked about share one open question, ``asks``.
    """

    def __init__(self) -> None:
        self.start: dict[int, tuple[int, int]] | None = None
        self.index: dict[int, int] = {}
        self.rule: list[int] = []
        self.place: list[tuple[int, int, int]] = []
        self.asks = 0
        self.count = [0, 0, 0]

    def add(self, seq: int, kind: str, nodes: list[int]) -> None:
        if kind == "store":
            self.__init__()
            self.start = {node: (seq, at) for at, node in enumerate(nodes)}
            return
        node = nodes[0]
        if self.start is not None:
            if kind == "fixed":
                self.start.setdefault(node, (seq, 0))
                return
            self.start.pop(node, None)
            if kind == "deleted" and self.start:
                self.start[node] = (seq, 0)
            return
        i = self.index.get(node)
        if i is None:
            i = self.index[node] = len(self.rule)
            self.rule.append(NEVER)
            self.place.append((AS_BEFORE, 0, seq))
            self.count[NEVER] += 1
            before = None
        else:
            before = self.rule[i]
        if kind == "fixed":
            if before == NEVER:
                self.place[i] = (ANYWAY, seq, 0)
            elif before == ASKED:
                self.place[i] = (self.asks, self.place[i][1], seq)
            self._becomes(i, ALWAYS)
            return
        self._becomes(i, NEVER)
        if kind == "deleted":
            if not self.count[ALWAYS] and not self.count[ASKED]:
                self.asks = len(self.rule)
            self._becomes(i, ALWAYS if self.count[ALWAYS] else ASKED)
            self.place[i] = (ANYWAY, seq, 0)

    def _becomes(self, i: int, rule: int) -> None:
        self.count[self.rule[i]] -= 1
        self.count[rule] += 1
        self.rule[i] = rule


def summarise(events: Iterable[tuple[int, str, list[int]]]) -> Run:
    run = Run()
    for seq, kind, nodes in events:
        run.add(seq, kind, nodes)
    return run


def apply(listed: dict[int, tuple[int, int]], run: Run) -> dict[int, tuple[int, int]]:
    """The list after a run. A list maps each node to its place key, (arrival, offset)."""
    if run.start is not None:
        return dict(run.start)
    highest = max((run.index.get(node, _UNNAMED) for node in listed), default=-1)
    after = {node: at for node, at in listed.items() if node not in run.index}
    for node, rule, (when, first, second) in zip(run.index, run.rule, run.place, strict=True):
        if rule == ALWAYS or rule == ASKED and highest >= run.asks:
            if when == AS_BEFORE:
                after[node] = listed.get(node, (second, 0))
            else:
                after[node] = (first if when == ANYWAY or highest >= when else second, 0)
    return after


def compose(early: Run, late: Run) -> Run:
    """One run that does what ``early`` and then ``late`` do. Associative, and linear in the nodes they name."""
    if late.start is not None:
        return late
    both = Run()
    if early.start is not None:
        both.start = apply(early.start, late)
        return both
    # A question of the late run is about the list the early one leaves: its nodes, and listed ones it did not name.
    reach = {rule: max((late.index.get(n, _UNNAMED) for n, r in zip(early.index, early.rule, strict=True) if r == rule), default=-1) for rule in (ALWAYS, ASKED)}
    known = len(early.rule)
    new_before = [0]
    for node in late.index:
        new_before.append(new_before[-1] + (node not in early.index))

    def about(t: int) -> int:
        """The question ``t`` of the late run, asked of the list before both; ``ANYWAY`` if the answer is yes."""
        if reach[ALWAYS] >= t:
            return ANYWAY
        return early.asks if reach[ASKED] >= t else known + new_before[t]

    both.index, both.rule, both.place, both.asks = dict(early.index), list(early.rule), list(early.place), early.asks
    asks = about(late.asks) if late.count[ASKED] else early.asks
    for node, rule, (when, first, second) in zip(late.index, late.rule, late.place, strict=True):
        before = early.index.get(node)
        if rule == ASKED and asks == ANYWAY:
            rule = ALWAYS
        place = (when, first, second)
        if when >= 0:
            asked = about(when)
            place = (ANYWAY, first, 0) if asked == ANYWAY else (asked, first, second)
        elif when == AS_BEFORE and before is not None:
            was = early.rule[before]
            place = early.place[before] if was == ALWAYS else (ANYWAY, second, 0) if was == NEVER else (early.asks, early.place[before][1], second)
        if before is None:
            both.index[node] = len(both.rule)
            both.rule.append(rule)
            both.place.append(place)
        else:
            both.rule[before], both.place[before] = rule, place
    if asks != ANYWAY:
        both.asks = asks
    both.count = [both.rule.count(r) for r in (NEVER, ALWAYS, ASKED)]
    return both


def ordered(listed: dict[int, tuple[int, int]]) -> list[int]:
    return sorted(listed, key=listed.__getitem__)


def _pack(run: Run) -> dict:
    """A run as flat columns; ``body`` holds rows of five numbers, or of three for a known list."""
    if run.start is not None:
        rows = [(node, *place) for node, place in run.start.items()]
    else:
        rows = [(node, rule, *place) for node, rule, place in zip(run.index, run.rule, run.place, strict=True)]
    return {"has_start": run.start is not None, "asks": run.asks, "body": np.array(rows, "<i8").tobytes()}


def _unpack(row) -> Run:
    run = Run()
    rows = np.frombuffer(bytes(row.body), "<i8").reshape(-1, 3 if row.has_start else 5).tolist()
    if row.has_start:
        run.start = {node: (seq, at) for node, seq, at in rows}
        return run
    run.asks = row.asks
    run.index = {r[0]: i for i, r in enumerate(rows)}
    run.rule = [r[1] for r in rows]
    run.place = [tuple(r[2:]) for r in rows]
    run.count = [run.rule.count(r) for r in (NEVER, ALWAYS, ASKED)]
    return run


SUMMARY = "chunk bigint, block bigint, has_start boolean, asks bigint, body binary"
_SUMMARY_ARROW = pa.schema([("chunk", pa.int64()), ("block", pa.int64()), ("has_start", pa.bool_()), ("asks", pa.int64()), ("body", pa.binary())])
_LIST_ARROW = pa.schema([("chunk", pa.int64()), ("nodes", pa.list_(pa.int64()))])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _summary(chunk: int, block: int, run: Run) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"chunk": chunk, "block": block, **_pack(run)}], _SUMMARY_ARROW)


def summarise_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summaries of the runs of one task; rows are (chunk, block, seq, kind, nodes), sorted by the first three."""
    here, run = None, Run()
    for chunk, block, seq, kind, nodes in _rows(batches):
        if (chunk, block) != here:
            if here:
                yield _summary(*here, run)
            here, run = (chunk, block), Run()
        run.add(seq, kind, nodes)
    if here:
        yield _summary(*here, run)


class _Row:
    def __init__(self, has_start, asks, body):
        self.has_start, self.asks, self.body = has_start, asks, body


def _compose_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One summary for each (chunk, group); rows come sorted by chunk, group and block."""
    here, run = None, Run()
    for chunk, group, _, *summary in _rows(batches):
        if (chunk, group) != here:
            if here:
                yield _summary(*here, run)
            here, run = (chunk, group), Run()
        run = compose(run, _unpack(_Row(*summary)))
    if here:
        yield _summary(*here, run)


def _final_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [{"chunk": chunk, "nodes": ordered(apply({}, _unpack(_Row(*summary))))} for chunk, _, *summary in _rows([batch])]
        yield pa.RecordBatch.from_pylist(out, _LIST_ARROW)


def compose_in_tree(summaries: DataFrame, blocks: int, fan: int = FAN) -> DataFrame:
    """One summary for each chunk, from summaries of blocks 0 to ``blocks`` - 1: ``fan`` neighbours become one, level by level."""
    while blocks > 1:
        group = F.floor(F.col("block") / fan).cast("bigint").alias("group")
        placed = summaries.select("chunk", group, "block", "has_start", "asks", "body")
        sorted_ = placed.repartition("chunk", "group").sortWithinPartitions("chunk", "group", "block")
        summaries = sorted_.mapInArrow(_compose_runs, SUMMARY)
        blocks = -(-blocks // fan)
    return summaries


def spread_deaths(events: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Give each death to the chunks it can matter to, as an event on that chunk.

    Removing a node that is not listed changes nothing, so between two events that name a node on
    a chunk only the first death of that node counts. Each (chunk, node) event therefore looks for
    the next death of its node: in its own block of arrival numbers, else in a later block. A
    window never spans more than one block of a node, or the blocks of a node.
    """
    on_chunk = events.where(F.col("kind") != "dead").select("chunk", "seq", "kind", "nodes")
    none = F.lit(None).cast("bigint")
    named = on_chunk.select("chunk", "seq", F.explode(F.array_distinct("nodes")).alias("node"), none.alias("death"))
    deaths = events.where(F.col("kind") == "dead").select(
        none.alias("chunk"), "seq", F.element_at("nodes", 1).alias("node"), F.col("seq").alias("death")
    )
    moments = named.unionByName(deaths).withColumn("block", block_of("seq", block_rows))
    # newest first, so that "next" is a running value over the rows before
    backwards = Window.partitionBy("node", "block").orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, -1)
    here = F.last("death", ignorenulls=True).over(backwards)
    firsts = moments.groupBy("node", "block").agg(F.min("death").alias("first"))
    later_blocks = Window.partitionBy("node").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    later = firsts.select("node", "block", F.last("first", ignorenulls=True).over(later_blocks).alias("later"))
    found = (
        moments.withColumn("here", here)
        .where(F.col("chunk").isNotNull())
        .join(later, ["node", "block"])
        .select("chunk", F.coalesce("here", "later").alias("seq"), "node")
    )
    hits = found.where(F.col("seq").isNotNull()).distinct()
    return on_chunk.unionByName(hits.select("chunk", "seq", F.lit("dead").alias("kind"), F.array("node").alias("nodes")))


def replica_map(events: DataFrame, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """The node list of every chunk after all events; arrival numbers are not negative.

    Runs of at most ``block_rows`` arrival numbers are summarised in parallel and composed in a tree, so no
    task meets more than ``fan`` summaries of one chunk, however long its history is.
    """
    newest = events.agg(F.max(block_of("seq", block_rows))).first()[0]
    blocked = spread_deaths(events, block_rows).withColumn("block", block_of("seq", block_rows))
    runs = blocked.repartition("chunk", "block").sortWithinPartitions("chunk", "block", "seq")
    summaries = runs.select("chunk", "block", "seq", "kind", "nodes").mapInArrow(summarise_runs, SUMMARY)
    whole = compose_in_tree(summaries, (newest or 0) + 1, fan)
    return whole.mapInArrow(_final_lists, "chunk bigint, nodes array<bigint>")
