"""Choosing nodes: placement of new chunks and shards, and replacement of a dead node's replicas."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.operators.chunks import CHUNK_KEY
from holdfast.operators.ranking import top_k_per_group
from holdfast.operators.running import BLOCK_ROWS, block_of
from holdfast.session import staged

_CARRIED, _REPORT, _REQUEST = 0, 1, 2


#: Rows that a task holds before it hands them on.
OUT_ROWS = 50_000


def _placer(k: int):
    """Walk each block in arrival order, keeping the nodes sorted by the space they last reported.

    Rows come sorted by block and arrival; a task holds one block's nodes and a batch of rows, not its history.
    """

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here: int | None = None
        space: dict[int, int] = {}
        order: list[tuple[int, int]] = []
        out: list[tuple[int, int, int]] = []
        for batch in batches:
            for block, kind, seq, node, free in zip(batch["block"], batch["kind"], batch["seq"], batch["node"], batch["free_space"]):
                if block != here and (block == block or here == here):  # NaN: rows without an arrival number are one block
                    here, space, order = block, {}, []
                if kind == _REQUEST:
                    if len(order) >= k:
                        out += [(seq, rank, order[rank - 1][1]) for rank in range(1, k + 1)]
                        if len(out) >= OUT_ROWS:
                            yield pd.DataFrame(out, columns=["seq", "rank", "node"], dtype="int64")
                            out = []
                    continue
                if node in space:
                    del order[bisect_left(order, (-space[node], node))]
                space[node] = free
                insort(order, (-free, node))
        yield pd.DataFrame(out, columns=["seq", "rank", "node"], dtype="int64")

    return place


# Aligned spans of blocks: number ``span`` of ``level`` holds the blocks ``span * 2**level`` up to the next one.
# Of each level, the first and the last span inside ``lo .. hi`` count where the span twice as long reaches out.
_SPANS = """
flatten(transform(sequence(0, CAST(floor(log2(hi - lo + 1)) AS INT) + 1), l -> filter(
  array_distinct(array(
    named_struct('level', l, 'span', shiftright(lo + shiftleft(1L, l) - 1, l)),
    named_struct('level', l, 'span', shiftright(hi + 1, l) - 1))),
  s -> shiftleft(s.span, l) >= lo AND shiftleft(s.span + 1, l) <= hi + 1
    AND NOT (shiftleft(shiftright(s.span, 1), l + 1) >= lo AND shiftleft(shiftright(s.span, 1) + 1, l + 1) <= hi + 1))))"""


def quiet_spans(held: DataFrame) -> DataFrame:
    """Rows with ``lo`` and ``hi``, once for each of the few aligned spans that make up that range of blocks."""
    return held.where("lo <= hi").withColumn("_s", F.explode(F.expr(_SPANS))).select(
        F.col("_s.level").alias("level"), F.col("_s.span").alias("span"), *[c for c in held.columns if c not in ("lo", "hi")])


def place(requests: DataFrame, reports: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` nodes with most free space as last reported before each request, ranked.

    Requests that arrive before ``k`` nodes have reported get no rows. Arrival numbers are shared
    by requests and reports and cut the history into blocks of bounded size; blocks are independent.
    A block starts from what was last reported by the nodes that report in it, and from the best
    ``k`` of the others: the blocks a node is quiet for are cut into aligned spans, each span keeps
    its best ``k``, and a block looks into the one span of each length that it lies in.
    """
    seen = reports.select(block_of("seq", block_rows).alias("block"), "seq", "node", "free_space")
    last = seen.groupBy("node", "block").agg(F.max_by("free_space", "seq").alias("free_space"))
    asked = requests.select(block_of("seq", block_rows).alias("block"), "seq")
    end = asked.agg(F.max("block")).scalar()
    following = F.lead("block").over(Window.partitionBy("node").orderBy("block"))
    held = last.withColumn("following", following)
    again = held.where("following is not null").select(F.col("following").alias("block"), "node", "free_space")
    quiet = held.select(
        (F.col("block") + 1).alias("lo"), F.least(F.col("following") - 1, end).alias("hi"), "node", "free_space")
    best = top_k_per_group(quiet_spans(quiet), ["level", "span"], k, F.desc("free_space"), F.asc("node"))
    levels = F.sequence(F.lit(0), F.floor(F.log2(end + 1)).cast("int") + 1)
    inside = asked.select("block").distinct().withColumn("level", F.explode(levels)).withColumn("span", F.expr("shiftright(block, level)"))
    idle = inside.join(best, ["level", "span"]).select("block", "node", "free_space")
    carried = again.unionByName(idle).select(
        "block", F.lit(_CARRIED).alias("kind"), F.lit(-1).cast("bigint").alias("seq"), "node", "free_space")
    none = F.lit(0).cast("bigint")
    steps = carried.unionByName(seen.withColumn("kind", F.lit(_REPORT))).unionByName(
        asked.select("block", "seq", F.lit(_REQUEST).alias("kind"), none.alias("node"), none.alias("free_space"))
    )
    walked = steps.repartition("block").sortWithinPartitions("block", "seq", "kind")
    return walked.select("block", "kind", "seq", "node", "free_space").mapInPandas(_placer(k), "seq bigint, rank bigint, node bigint")


def place_rejections(requests: DataFrame, reports: DataFrame, k: int) -> DataFrame:
    """Each request as placed or rejected: rejected until ``k`` nodes have reported once."""
    first = reports.groupBy("node").agg(F.min("seq").alias("seq"))
    kth = first.orderBy("seq").limit(k).agg(F.when(F.count("*") == k, F.max("seq")).alias("ready_at")).scalar()
    placed = F.coalesce(F.col("seq") > kth, F.lit(False))
    return requests.select("seq", F.when(placed, "placed").otherwise("rejected").alias("status"))


def rereplicate(replicas: DataFrame, nodes: DataFrame, dead: DataFrame) -> DataFrame:
    """For each replica lost with a dead node: a live donor and the node to copy it to.

    The target is the node with most free space that does not hold the chunk yet; a second loss
    of the same chunk takes the next one. Replicas without donor or target yield nothing.

    Only chunks with a replica on a dead node are grouped. Their lists are written down first. No chunk can rule out or ask for more nodes than
    its list is long, so twice the longest of those lists is all of the node table that can ever
    be needed; it is found by a distributed top-k.
    """
    gone = F.coalesce(F.col("is_dead"), F.lit(False)).alias("gone")
    fallen = dead.select("node").distinct()
    affected = staged(replicas.join(fallen, "node", "left_semi").select(*CHUNK_KEY).distinct(), "affected-chunks")
    marked = replicas.join(affected, CHUNK_KEY, "left_semi").join(fallen.withColumn("is_dead", F.lit(True)), "node", "left")
    lists = marked.groupBy(*CHUNK_KEY).agg(F.array_sort(F.collect_list(F.struct("rank", "node", gone))).alias("holders"))
    lists = staged(lists, "affected-lists")
    longest = lists.agg(F.max(F.size("holders"))).first()[0] or 1
    best_first = [F.desc("free_space"), F.asc("node")]
    live = nodes.join(dead.select("node"), "node", "left_anti").orderBy(*best_first).limit(2 * longest)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("free_space")).alias("order"), "node")))
    targets = live.agg(ordered).scalar()
    names = lambda holders, gone_wanted: F.transform(
        F.filter(holders, lambda h: h["gone"] == gone_wanted), lambda h: h["node"]
    )
    split = lists.select(
        *CHUNK_KEY, names(F.col("holders"), False).alias("alive"), names(F.col("holders"), True).alias("lost"),
        targets.alias("targets"),
    ).where(F.size("alive") > 0)
    open_nodes = F.filter("targets", lambda t: ~F.array_contains(F.col("alive"), t["node"]))
    each = split.select(*CHUNK_KEY, "alive", open_nodes.alias("open"), F.posexplode("lost").alias("at", "dead_node"))
    return each.select(
        *CHUNK_KEY, "dead_node", F.element_at("alive", 1).alias("donor"), F.get("open", F.col("at"))["node"].alias("target")
    ).where(F.col("target").isNotNull())
