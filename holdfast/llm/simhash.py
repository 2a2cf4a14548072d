"""SimHash near-duplicates: 64-bit fingerprints, linked through pigeonring chains.

Cut two fingerprints into ``m`` segments on a ring. If they differ in at most ``t`` bits in all, some
segment starts a chain in which the first ``l`` segments together differ in at most ``l * t / m`` bits,
for every ``l`` up to ``m``. Where that budget is below one the segments must be equal, and these
leading equal segments are the join key; the longer chains prune what the key lets through before the
whole distance is looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import map_rows, query, table, utf8
from holdfast.llm.components import connected
from holdfast.llm.shingles import shingle_hashes
from holdfast.session import staged

BITS = 64
SEGMENTS = 16
BUDGET = 2
DENSE = 512


def _byte_counts():
    import numpy as np

    return np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def majority_bits(hashes, ones=None) -> int:
    """The bits that are set in over half of ``hashes``, as an unsigned integer; none for no hashes."""
    import numpy as np

    ones = _byte_counts() if ones is None else ones
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    total = 0
    for lane in range(8):
        votes = np.bincount(lanes[:, lane], minlength=256) @ ones
        for bit in range(8):
            if 2 * int(votes[bit]) > len(hashes):
                total |= 1 << (8 * lane + bit)
    return total


def fingerprint(data: bytes, width: int, ones=None) -> int:
    """SimHash of the word shingles of ``data``, as an unsigned integer."""
    return majority_bits(shingle_hashes(data, width), ones)


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``(doc_id, fp)`` for every row; ``fp`` holds the 64 bits as a signed long. No words: zero."""

    def run(rows):
        ones = _byte_counts()
        for doc_id, text in rows:
            value = fingerprint(utf8(text), width, ones)
            yield doc_id, value - (1 << 64) if value >> 63 else value

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id bigint, fp bigint", run)


def _rotated(value: Column, by: int) -> Column:
    return value if by == 0 else F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, BITS - by))


def chain_starts(fps: DataFrame, budget: int, segments: int) -> DataFrame:
    """One row for each fingerprint and ring position: the position, the key, the rotated fingerprint."""
    step = BITS // segments
    equal = -(-segments // budget) - 1  # chains of so many segments have a budget below one
    turned = [
        F.struct(F.lit(i).alias("at"), _rotated(F.col("fp"), step * i).alias("ring")) for i in range(segments)
    ]
    return fps.select("fp", "rep", F.explode(F.array(*turned)).alias("s")).select(
        F.col("s.at").alias("at"), F.shiftrightunsigned("s.ring", BITS - step * equal).alias("key"),
        F.col("s.ring").alias("ring"), "fp", "rep")


def within_chain(a: Column, b: Column, budget: int, segments: int) -> Column:
    """Every chain from this start keeps its budget, shorter chains first; the last one is the whole ring."""
    step = BITS // segments
    differ = a.bitwiseXOR(b)
    last = {length * budget // segments: length for length in range(1, segments + 1)}
    test = F.lit(True)
    for allowed, length in sorted(last.items()):
        test = test & (F.bit_count(F.shiftrightunsigned(differ, BITS - step * length) if step * length < BITS else differ) <= allowed)
    return test


def links(fps: DataFrame, budget: int = BUDGET, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """Links ``(a, b)`` that join exactly the fingerprints within ``budget`` bits, over ``(fp, rep)``.

    A key that more than ``dense`` fingerprints share is not joined with itself. All fingerprints below
    such keys go by way of the values between them instead: two fingerprints within two bits have a value
    within one bit of both, so each names its 65 values within one bit and meets the others there.
    At most 65 fingerprints can meet at a value, so the work is 65 rows each. That needs a budget of 2.
    """
    if budget != 2:
        raise ValueError("values between two fingerprints are only worked out for a budget of two bits")
    starts = chain_starts(fps, budget, segments)
    crowded = starts.groupBy("at", "key").count().where(F.col("count") > dense).select("at", "key")
    thin = starts.join(crowded, ["at", "key"], "left_anti")
    a, b = thin.alias("a"), thin.alias("b")
    near = a.join(
        b,
        (F.col("a.at") == F.col("b.at")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp"))
        & within_chain(F.col("a.ring"), F.col("b.ring"), budget, segments),
    ).select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b"))
    close = starts.join(crowded, ["at", "key"], "left_semi").select("fp", "rep").distinct()
    between = [F.lit(0).cast("long")] + [F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(BITS)]
    meets = close.select("rep", F.explode(F.array(*[F.col("fp").bitwiseXOR(x) for x in between])).alias("value"))
    least = meets.groupBy("value").agg(F.min("rep").alias("least"), F.collect_set("rep").alias("all"))
    met = least.select(F.explode("all").alias("a"), F.col("least").alias("b")).where("a <> b")
    return near.unionByName(met)


def fingerprint_groups(prints: DataFrame, budget: int = BUDGET, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """``(fp, label)`` for different fingerprints ``fp``; those linked within ``budget`` bits have one label, the least of them."""
    linked = connected(links(prints.select("fp", F.col("fp").alias("rep")), budget, segments, dense), "a", "b")
    return prints.join(linked, prints.fp == linked.node, "left").select("fp", F.coalesce("component", "fp").alias("label"))


def near_duplicates(docs: DataFrame, width: int = 3, budget: int = BUDGET, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """``(doc_id, fp, component_id)``: documents linked by fingerprints within ``budget`` bits.

    Equal fingerprints count once, so exact copies never meet each other. Null and empty texts have fingerprint
    zero and are linked like any other. Rows without a doc_id keep their fingerprint and its component, but name
    no component. Repeated rows stay. An empty table gives no rows.
    """
    marked = staged(fingerprints(docs, width), "fingerprints")
    prints = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "representatives")
    groups = staged(prints.join(fingerprint_groups(prints.select("fp"), budget, segments, dense), "fp"), "groups")
    least = groups.groupBy("label").agg(F.min("rep").alias("component_id"))
    classes = groups.join(least, "label").select("fp", "component_id")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def first_of_each_group(docs: DataFrame, width: int = 3, budget: int = BUDGET) -> DataFrame:
    """The rows of ``docs``, whatever their columns, that come first in their group of near duplicates.

    First is the smallest doc_id, a missing one last; of several texts under it the one of least hash. Rows alike in
    doc_id and text are one. Null and empty texts are one group. An empty table gives no rows.
    """
    digest = F.xxhash64("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", digest.alias("digest"))

    def run(rows):
        ones = _byte_counts()
        for doc_id, text, name in rows:
            value = fingerprint(utf8(text), width, ones)
            yield doc_id, name, value - (1 << 64) if value >> 63 else value

    marked = staged(map_rows(rows, "doc_id bigint, digest bigint, fp bigint", run), "fingerprints")
    groups = fingerprint_groups(staged(marked.select("fp").distinct(), "prints"), budget)
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "digest")
    first = marked.join(groups, "fp").groupBy("label").agg(F.min(place).alias("first")).select("first.*")
    held = docs.select(
        F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), digest.alias("digest"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return held.join(first, ["none", "id", "digest"], "left_semi").dropDuplicates(["none", "id", "digest"]).select("row.*")


@query("op2_simhash_near_dedup")
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
