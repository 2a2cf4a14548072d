"""Ranked lexical search: a tree over documents' frequency-ordered term vectors, searched by branch and bound.

Documents restricted to the terms of the queries share paths of a trie while their most frequent terms
agree. Each node knows, for the documents below it, the largest occurrence count of every term and the
smallest length factor, so no document below can score higher than these two say. A query walks the tree
depth first, best child first, and leaves out what cannot reach its current k-th place.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.common import map_rows, query, table, utf8
from holdfast.session import drop_path, fresh_path

TOP = 10
#: Documents in one tree, terms held by one tree, documents at a leaf.
TREE_DOCS = 4_096
TREE_TERMS = 1_000_000
LEAF_DOCS = 8
#: Different terms of queries that are searched together; more queries make another round.
ROUND_TERMS = 100_000
SCALE = 1_000_000_000

_KEPT = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all characters beyond ASCII; A-Z lower-cased."""
    return utf8(text).translate(_KEPT).split()


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def gain(tf, m):
    """What ``tf`` occurrences add per weight in a document with length factor ``m``; grows with tf, falls with m."""
    return (SCALE * tf) // (1000 * tf + 8 * m)


class Tree:
    """Documents as sorted sparse rows, nodes as ranges of them.

    ``values`` maps ``row * width + term`` (both of documents and of nodes, sorted) to occurrence counts. A
    node covers ``first:last`` documents that share their ``depth`` most frequent terms.
    """

    def __init__(self, lengths: np.ndarray, term_ids: np.ndarray, tfs: np.ndarray, m: np.ndarray, width: int, leaf: int = LEAF_DOCS):
        """``lengths[i]`` entries of ``term_ids`` (ascending: a smaller number is a more frequent term) and ``tfs`` per document."""
        self.width, self.leaf = width, leaf
        ends = np.cumsum(lengths)
        packed = term_ids.astype(">u4").tobytes()  # big-endian, so that bytes sort as the numbers do
        vectors = [packed[4 * (end - n):4 * end] for end, n in zip(ends, lengths, strict=True)]
        self.order = np.array(sorted(range(len(vectors)), key=vectors.__getitem__), np.int64)
        self.m = m[self.order]
        self.first: list[int] = []
        self.last: list[int] = []
        self.children: list[np.ndarray] = []
        self._grow([vectors[i] for i in self.order])
        row = np.empty(len(vectors), np.int64)
        row[self.order] = np.arange(len(vectors))
        self.doc_keys, self.doc_values = self._largest(np.repeat(row, lengths) * width + term_ids, tfs)
        self._summarise()

    def _grow(self, vectors: list[bytes]) -> None:
        """Nodes from the root down, parents first; a path without branches is one node, few documents are a leaf."""
        waiting = [(0, len(vectors), 0, -1)]
        kids: list[list[int]] = []
        while waiting:
            first, last, at, parent = waiting.pop()
            me = len(self.first)
            self.first.append(first)
            self.last.append(last)
            kids.append([])
            if parent >= 0:
                kids[parent].append(me)
            if last - first <= self.leaf:
                continue
            lowest, highest = vectors[first], vectors[last - 1]
            while at < len(lowest) and lowest[at:at + 4] == highest[at:at + 4]:
                at += 4
            if at >= len(highest):  # all the same vector: any cut will do
                step = max(self.leaf, -(-(last - first) // 64))
                waiting += [(i, min(i + step, last), at, me) for i in range(first, last, step)]
                continue
            start = first
            for i in range(first + 1, last + 1):
                if i == last or vectors[i][at:at + 4] != vectors[start][at:at + 4]:
                    waiting.append((start, i, at, me))
                    start = i
        self.children = [np.array(k, np.int64) for k in kids]

    def _summarise(self) -> None:
        """The largest counts and the smallest length factor below every node, nodes of one height after the other."""
        n_nodes = len(self.first)
        parent, height = np.full(n_nodes, -1), np.zeros(n_nodes, np.int64)
        leaf_of = np.zeros(len(self.order), np.int64)
        self.m_min = np.full(n_nodes, np.iinfo(np.int64).max)
        for node in range(n_nodes - 1, -1, -1):  # children have larger numbers than their parents
            kids = self.children[node]
            if len(kids):
                parent[kids] = node
                height[node] = height[kids].max() + 1
                self.m_min[node] = self.m_min[kids].min()
            else:
                leaf_of[self.first[node]:self.last[node]] = node
                self.m_min[node] = self.m[self.first[node]:self.last[node]].min(initial=self.m_min[node])
        waiting = {0: [(leaf_of[self.doc_keys // self.width] * self.width + self.doc_keys % self.width, self.doc_values)]}
        found = []
        for level in range(int(height.max()) + 1):
            keys, values = self._largest(*(np.concatenate(x) for x in zip(*waiting.pop(level), strict=True)))
            found.append((keys, values))
            up = parent[keys // self.width]
            for target in np.unique(height[up[up >= 0]]):
                pick = (up >= 0) & (height[up] == target)
                waiting.setdefault(int(target), []).append((up[pick] * self.width + keys[pick] % self.width, values[pick]))
        self.node_keys, self.node_values = self._largest(*(np.concatenate(x) for x in zip(*found, strict=True)))

    @staticmethod
    def _largest(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return keys.astype(np.int64), values.astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[new], np.maximum.reduceat(values, new)

    def _scores(self, keys, values, rows, m, wanted, weights) -> np.ndarray:
        """Sum of weight times gain over the wanted terms, for each of ``rows``."""
        if not len(keys):
            return np.zeros(len(rows), np.int64)
        sought = rows[:, None] * self.width + wanted[None, :]
        at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
        tf = np.where(keys[at] == sought, values[at], 0)
        return (weights * gain(tf, m[:, None])).sum(1)

    def search(self, wanted: np.ndarray, weights: np.ndarray, best: list, top: int, ids: np.ndarray) -> int:
        """Put every document that belongs to the ``top`` into the heap ``best`` of (score, -doc_id); scored documents are counted."""
        scored = 0
        waiting = [(0, np.iinfo(np.int64).max)]
        while waiting:
            node, bound = waiting.pop()
            if bound <= 0 or len(best) == top and bound < best[0][0]:
                continue
            kids = self.children[node]
            if len(kids):
                bounds = self._scores(self.node_keys, self.node_values, kids, self.m_min[kids], wanted, weights)
                for i in np.argsort(bounds, kind="stable"):
                    waiting.append((int(kids[i]), int(bounds[i])))
                continue
            rows = np.arange(self.first[node], self.last[node])
            scored += len(rows)
            for row, score in zip(rows, self._scores(self.doc_keys, self.doc_values, rows, self.m[rows], wanted, weights), strict=True):
                entry = (int(score), -int(ids[self.order[row]]))
                if score > 0 and (len(best) < top or entry > best[0]):
                    (heapq.heappush if len(best) < top else heapq.heapreplace)(best, entry)
        return scored


VECTORS = "doc_id bigint, n bigint, terms binary, tfs binary"


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, terms, tfs)``: length of every document and its occurrences of the vocabulary's terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(rows):
        known = shared.value
        for doc_id, text in rows:
            words = terms(text)
            found = Counter(map(known.get, words))
            found.pop(None, None)
            yield doc_id, len(words), np.fromiter(found.keys(), "<i4", len(found)).tobytes(), np.fromiter(found.values(), "<i4", len(found)).tobytes()

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), VECTORS, run)


def _document_frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """In how many documents each of the ``size`` terms is; tasks add up their own before anything moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            packed = batch.column("terms")
            for i in range(batch.num_rows):
                df[np.frombuffer(packed[i].as_buffer(), "<i4")] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at])], names=["term", "df"])

    total = np.zeros(size, np.int64)
    for row in vectors.select("terms").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        total[row.term] = row.df
    return total


def _search_round(vectors: DataFrame, items: list[tuple], size: int, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """Per task, the best ``top`` of its documents for each item, as ``(item_id, doc_id, score)``."""
    df = _document_frequencies(vectors, size)
    rank = np.empty(size, np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(size)
    queries = [(item_id, np.sort(rank[list(mine)])) for item_id, mine in items]
    weight = np.zeros(size, np.int64)
    weight[rank] = [term_weight(n_docs, int(d)) for d in df]
    shared = vectors.sparkSession.sparkContext.broadcast((rank, queries, weight))

    def run(rows):
        rank, queries, weight = shared.value
        best: list[list] = [[] for _ in queries]

        def search(held):
            ids, lengths, term_ids, tfs, m = zip(*held, strict=True)
            tree = Tree(np.array(lengths), np.concatenate(term_ids), np.concatenate(tfs), np.array(m, np.int64), max(size, 1))
            ids = np.array(ids, np.int64)
            for (_, wanted), mine in zip(queries, best, strict=True):
                tree.search(wanted, weight[wanted], mine, top, ids)

        held, many = [], 0
        for doc_id, n, packed, counts in rows:
            ranked = rank[np.frombuffer(packed, "<i4")]
            order = np.argsort(ranked)
            m = 10 + (90 * n * n_docs) // n_terms
            held.append((doc_id, len(ranked), ranked[order], np.frombuffer(counts, "<i4")[order].astype(np.int64), m))
            many += len(ranked)
            if len(held) >= TREE_DOCS or many >= TREE_TERMS:
                search(held)
                held, many = [], 0
        if held:
            search(held)
        for (item_id, _), mine in zip(queries, best, strict=True):
            for score, minus_id in mine:
                yield item_id, -minus_id, score

    some = vectors.where("doc_id is not null and length(terms) > 0")
    return map_rows(some, "item_id bigint, doc_id bigint, score bigint", run)


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, round_terms: int = ROUND_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of highest score above 0 for each item.

    ``docs`` has ``doc_id, text`` and ``items`` has ``item_id, text``; other columns are not read. Null and
    empty texts have no terms: such documents are found by no item and such items find none. Rows that share an
    item_id (a missing one included) are one item; rows that share a doc_id are ranked each. Documents without
    doc_id count in all statistics but cannot be named, so they are not ranked. Equal scores go by ascending
    doc_id. Empty tables give no rows.

    Documents are read once per round of items. A round holds items of at most ``round_terms`` terms (an item
    with more has its own), so what is broadcast is bounded; rounds follow one another. Each task searches tree
    after tree with one set of current k-th scores and returns at most ``top`` rows an item.
    """
    spark = docs.sparkSession

    def item_terms(rows):
        for item_id, text in rows:
            for term in set(terms(text)):
                yield item_id, term

    pairs = map_rows(items.select(F.col("item_id").cast("long"), "text"), "item_id bigint, term binary", item_terms).distinct()
    pairs_path = fresh_path(spark, "item-terms")
    pairs.write.parquet(pairs_path)
    pairs = spark.read.schema("item_id bigint, term binary").parquet(pairs_path)
    rounds = max(1, -(-pairs.count() // round_terms))
    number = F.pmod(F.xxhash64("item_id"), F.lit(rounds))
    found = []
    for one in range(rounds):
        mine: dict = {}
        vocabulary: dict[bytes, int] = {}
        for row in pairs.where(number == one).toLocalIterator():
            mine.setdefault(row.item_id, []).append(vocabulary.setdefault(bytes(row.term), len(vocabulary)))
        vectors_path, hits_path = fresh_path(spark, "vectors"), fresh_path(spark, "hits")
        _vectors(docs, vocabulary).write.parquet(vectors_path)
        vectors = spark.read.schema(VECTORS).parquet(vectors_path)
        n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        queries = sorted(mine.items(), key=lambda i: (i[0] is None, i[0] or 0))
        _search_round(vectors, queries, len(vocabulary), n_docs, n_terms, top).write.parquet(hits_path)
        drop_path(spark, vectors_path)
        found.append(hits_path)
    drop_path(spark, pairs_path)
    hits = spark.read.schema("item_id bigint, doc_id bigint, score bigint").parquet(*found)
    best_first = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return hits.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents WHERE doc_id IS NOT NULL
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM lengths),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL),
item AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), scored AS (
  SELECT item_id, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // len)))) AS BIGINT) AS score
  FROM item JOIN df USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id), totals GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY rank <= 10"""


@query("op11_ranked_search", _SQL)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
