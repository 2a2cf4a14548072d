"""Exact top-k against the SQL twin and brute force with ties."""

from __future__ import annotations

import math

import pytest

from holdfast.llm import topk
from tests.oracle import compare, connect


def test_matches_sql(spark, sf_dir):
    assert not compare(topk.op5_exact_top_k(spark, sf_dir), connect(sf_dir), topk.TOP_K_SQL)


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 16, "query_rows": 3, "leaf": 2}])
def test_ties_odd_vectors_and_few_rows(spark, sizes):
    rows = [(i, [float(i % 3), float(i % 5) / 4, -1.0]) for i in range(90)]
    rows += [(200 + i, [1.0, 1.0, 1.0]) for i in range(40)] + [(300, None), (320, [1.0, None, 0.0]), (340, [math.nan, 0.0, 0.0]), (360, [math.inf, 0.0, 0.0]), (380, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    vectors = topk.whole_vectors(df)
    want = set()
    for q in whole:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:20]
            want |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)}
    got = {tuple(r) for r in topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), **sizes).collect()}
    assert got == want
    assert topk.top_k(vectors.where("false"), vectors.where("false")).count() == 0
    assert topk.top_k(vectors.limit(1), vectors.limit(1)).count() == 0


def test_repeated_ids_and_copies(spark):
    """All rows of an id are candidates for others, none for itself; copies tie and go by id."""
    rows = [(20, [2]), (20, [1]), (1, [5]), (1, [7]), (2, [7]), (3, [7]), (40, [1])]
    vectors = spark.createDataFrame(rows, "vec_id long, vec array<long>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=4, shard_rows=2, query_rows=1).collect()}
    assert got == {(20, 1): (1, 7), (20, 2): (2, 7), (20, 3): (3, 7), (20, 4): (1, 5), (40, 1): (1, 7), (40, 2): (2, 7), (40, 3): (3, 7), (40, 4): (1, 5)}
