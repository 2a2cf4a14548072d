"""Exact top-k by inner product: a ball tree per shard, searched by branch and bound.

A ball with centre c and radius r holds no vector whose inner product with q is above q.c + |q| r. A block of
queries walks a tree together, depth first and the ball of higher bounds first; a query leaves the block at
every ball whose bound is below the k-th score it has so far. That score is shared between shards: a block
meets them in rounds, each with a few times as many shards as all before, and starts a round with the k-th
scores that the rounds before it found.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.common import query, table
from holdfast.session import staged

SHARD_ROWS = 8_192
QUERY_ROWS = 2_048
LEAF = 256
#: How many times as many shards a block has met after each round.
GROWTH = 4


class BallTree:
    """Balls over the rows of ``vectors`` (float64 whole numbers), halved along their widest spread."""

    def __init__(self, vectors, leaf: int = LEAF):
        import numpy as np

        self.order = np.arange(len(vectors))
        self.vectors = vectors
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        centres, radii = [], []
        waiting = [(0, len(vectors), -1, 0)]
        while waiting:
            lo, hi, parent, side = waiting.pop()
            node = len(self.spans)
            if parent >= 0:
                kept = self.children[parent]
                self.children[parent] = (node, kept[1]) if side == 0 else (kept[0], node)
            rows = vectors[self.order[lo:hi]]
            centre = rows.mean(axis=0)
            away = rows - centre
            self.spans.append((lo, hi))
            centres.append(centre)
            radii.append(float(np.sqrt((away * away).sum(axis=1).max())))
            if hi - lo <= leaf or radii[-1] == 0.0:
                self.children.append(None)
                continue
            axis = int((away * away).sum(axis=0).argmax())
            self.order[lo:hi] = self.order[lo:hi][np.argsort(rows[:, axis], kind="stable")]
            middle = (lo + hi) // 2
            self.children.append((-1, -1))
            waiting += [(lo, middle, node, 0), (middle, hi, node, 1)]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.sorted = vectors[self.order]

    def bounds(self, queries):
        """Upper bounds of the inner product, by query and node, rounded away from zero error."""
        import numpy as np

        lengths = np.sqrt((queries * queries).sum(axis=1))
        exact = queries @ self.centres.T + lengths[:, None] * self.radii[None, :]
        return exact + 1e-9 * (np.abs(exact) + lengths[:, None] * (1 + np.abs(self.centres).max())) + 1e-6

    def search(self, queries, own, ids, k: int, floors):
        """Row numbers of ``queries``, ids and scores of the best ``k`` rows at ``floors`` or above; ties to smaller ids.

        ``own`` are the ids left out for each query, ``ids`` those of the vectors as they were given.
        """
        import numpy as np

        bounds = self.bounds(queries)
        floors = floors.copy()
        scores = np.full((len(queries), k), -np.inf)
        names = np.full((len(queries), k), np.iinfo(np.int64).max)
        waiting = [(0, np.arange(len(queries)))]
        while waiting:
            node, asking = waiting.pop()
            asking = asking[bounds[asking, node] >= floors[asking]]
            if not len(asking):
                continue
            if kids := self.children[node]:
                waiting += [(kid, asking) for kid in sorted(kids, key=lambda kid: float(bounds[asking, kid].sum()))]
                continue
            lo, hi = self.spans[node]
            found = queries[asking] @ self.sorted[lo:hi].T
            here = ids[self.order[lo:hi]]
            hit = (found >= floors[asking, None]) & (here[None, :] != own[asking, None])
            some = np.flatnonzero(hit.any(axis=1))
            if not len(some):
                continue
            rows = asking[some]
            both = np.concatenate([scores[rows], np.where(hit[some], found[some], -np.inf)], axis=1)
            named = np.concatenate([names[rows], np.where(hit[some], here[None, :], np.iinfo(np.int64).max)], axis=1)
            order = np.lexsort((named, -both), axis=-1)[:, :k]
            scores[rows], names[rows] = np.take_along_axis(both, order, 1), np.take_along_axis(named, order, 1)
            floors[rows] = np.maximum(floors[rows], scores[rows, k - 1])
        kept = np.isfinite(scores)
        return np.nonzero(kept)[0], names[kept], scores[kept].astype(np.int64)


def _matrix(column):
    import numpy as np

    width = max((len(v) for v in column), default=0)
    if all(len(v) == width for v in column):
        return np.array(column, dtype=np.float64).reshape(len(column), width)
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _searcher(k: int, leaf: int):
    def run(queries, rows):
        import numpy as np
        import pandas as pd

        if not len(queries) or not len(rows):
            return pd.DataFrame({c: np.empty(0, np.int64) for c in ("query_id", "vec_id", "score")})
        rows = rows.sort_values("vec_id", kind="stable")
        data, asked = _matrix(rows.vec.tolist()), _matrix(queries.vec.tolist())
        width = max(data.shape[1], asked.shape[1])
        data, asked = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (data, asked))
        own = queries.query_id.to_numpy()
        floors = queries.floor.astype("float64").fillna(-np.inf).to_numpy()
        at, names, scores = BallTree(data, leaf).search(asked, own, rows.vec_id.to_numpy(), k, floors)
        return pd.DataFrame({"query_id": own[at], "vec_id": names, "score": scores})

    return run


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """``(vec_id, vec)`` with components floor(scale * x); vectors that are or hold null, NaN or infinity are left out."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return df.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(vector_col, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("vec"))


def _met_in(first: int, stop: int, shards: int):
    """Whether a block meets a shard among the first-th to the stop-th of its own, which start at a place of the block's."""

    def met(block, shard):
        turn = F.pmod(shard - F.pmod(F.xxhash64(F.lit(2), block), F.lit(shards)), F.lit(shards))
        return (turn >= first) & (turn < stop)

    return met


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, leaf: int = LEAF) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` best rows of ``vectors``, itself left out.

    Both are ``(vec_id, vec)`` with whole components, scores below 2**53. Ties go to the smaller vec_id. A
    query with fewer rows gets all. Shorter vectors count as filled up with zeros. Rows that repeat a vec_id
    are all candidates; such a query is asked once, with its smallest vector. No queries or no vectors: no rows.

    Shards and query blocks have bounded sizes, and each pair of them is one group in one of the rounds. A block
    starts with one shard and meets ``GROWTH`` times as many in all with each round, so a query takes about
    ``GROWTH * k`` candidates from a round, and rounds are as many as the logarithm of the shards.
    """
    vectors = staged(vectors, "vectors")
    queries = staged(queries.groupBy("vec_id").agg(F.min("vec").alias("vec")), "query-vectors")
    shards = max(1, math.ceil(vectors.count() / shard_rows))
    blocks = max(1, math.ceil(queries.count() / query_rows))
    rows = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(shards)).cast("int"))
    asked = queries.select(F.col("vec_id").alias("query_id"), "vec", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int").alias("block"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found, first, stop = None, 0, 1
    while first < shards:
        met = _met_in(first, stop, shards)
        now = asked.withColumn("floor", F.lit(None).cast("double"))
        if found is not None:
            floors = found.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("floor"))
            now = asked.join(floors, "query_id", "left")
        every = F.sequence(F.lit(0), F.lit(shards - 1))
        sent = now.select("query_id", "vec", "floor", "block", F.explode(F.filter(every, lambda s: met(F.col("block"), s))).alias("shard"))
        others = F.sequence(F.lit(0), F.lit(blocks - 1))
        spread = rows.select("vec_id", "vec", "shard", F.explode(F.filter(others, lambda b: met(b, F.col("shard")))).alias("block"))
        hits = sent.groupBy("block", "shard").cogroup(spread.groupBy("block", "shard")).applyInPandas(
            _searcher(k, leaf), "query_id long, vec_id long, score long")
        every_hit = hits if found is None else found.select("query_id", "vec_id", "score").unionByName(hits)
        found = staged(every_hit.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "top-k")
        first, stop = stop, stop * GROWTH
    return found.select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


@query("op5_exact_top_k", TOP_K_SQL)
def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))
