"""Ranked search: trees and whole queries against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from holdfast.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def slow_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow_rank(docs, items, top=10):
    """All scores by the definition; ``docs`` are (doc_id, text) rows, ``items`` a dictionary of texts."""
    bags = [(d, Counter(slow_terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_docs, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items.items():
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in set(slow_terms(text))}
        scores = []
        for d, b, n in bags:
            m = 100 - 90 + (90 * n * n_docs) // length
            scores.append((-sum(w * ((1000000000 * b[t]) // (1000 * b[t] + 8 * m)) for t, w in weight.items() if t in b), d))
        ranked = sorted(s for s in scores if s[0] < 0 and s[1] is not None)[:top]
        out += [(item, i + 1, d, -s) for i, (s, d) in enumerate(ranked)]
    return out


def test_terms():
    for text in ["A-b_c 4.5", "É ßX 漢字,字", "", None, "\x7f\x00a", "Zz@[`{"]:
        assert [t.decode() for t in lexical.terms(text)] == slow_terms(text)


@pytest.mark.parametrize("leaf", [1, 3, 50])
@pytest.mark.parametrize("same", [False, True])
def test_tree_finds_what_scoring_all_finds(leaf, same):
    rng = np.random.default_rng(leaf)
    width, docs = 30, 400
    vectors = [np.sort(rng.choice(width, rng.integers(0, 12), replace=False, p=np.arange(width, 0, -1) / sum(range(width + 1)))) for _ in range(docs)]
    if same:
        vectors[100:300] = [vectors[100]] * 200
    tfs = [rng.integers(1, 6, len(v)) for v in vectors]
    m = rng.integers(10, 300, docs)
    tree = lexical.Tree(np.array([len(v) for v in vectors]), np.concatenate(vectors), np.concatenate(tfs), m, width, leaf)
    scored = 0
    for _ in range(30):
        wanted = np.sort(rng.choice(width, 8, replace=False))
        weights = rng.integers(0, 5000, 8)
        best: list = []
        scored += tree.search(wanted, weights, best, 5, np.arange(docs))
        by_term = dict(zip(wanted, weights, strict=True))
        scores = [(sum(int(by_term[t]) * int(lexical.gain(f, m[d])) for t, f in zip(v, g, strict=True) if t in by_term), -d)
                  for d, (v, g) in enumerate(zip(vectors, tfs, strict=True))]
        assert sorted(best, reverse=True) == sorted((s for s in scores if s[0] > 0), reverse=True)[:5]
    assert scored < (30 * docs if leaf < 50 else 30 * docs + 1)


def test_bounds_hold():
    rng = np.random.default_rng(5)
    tree = lexical.Tree(np.full(60, 4), np.sort(np.array([rng.choice(12, 4, replace=False) for _ in range(60)])).ravel(), rng.integers(1, 9, 240), rng.integers(10, 99, 60), 12, 2)
    wanted, weights = np.arange(12), rng.integers(1, 99, 12)
    for node, (a, b) in enumerate(zip(tree.first, tree.last, strict=True)):
        bound = tree._scores(tree.node_keys, tree.node_values, np.array([node]), tree.m_min[[node]], wanted, weights)[0]
        rows = np.arange(a, b)
        assert bound >= tree._scores(tree.doc_keys, tree.doc_values, rows, tree.m[rows], wanted, weights).max()


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(words, weights=range(1, 41), k=rng.randrange(0, 60)))) for i in range(300)]
    docs += [(500 + i, docs[7][1]) for i in range(50)] + [(900, "w1 " * 30_000), (901, None), (902, "W1-w2,w39"), (7, "W3 w39"), (None, "w39 w38")]
    return docs, {i: " ".join(rng.sample(words, 9)) for i in range(12)} | {77: "unheard of", 78: None, 79: "w39 W39 w39"}


@pytest.mark.parametrize("round_terms", [10, 100_000])
def test_all_rows_by_brute_force(spark, random_rows, round_terms):
    docs, items = random_rows
    have = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, score string, item_id int").repartition(3)
    ask = spark.createDataFrame([(i, t, 9) for i, t in items.items()], "item_id long, text string, doc_id int")
    got = [tuple(r) for r in lexical.rank_documents(have, ask, round_terms=round_terms).collect()]
    assert sorted(got) == sorted(slow_rank(docs, items))


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    items = odd_docs.selectExpr("doc_id item_id", "text")
    assert lexical.rank_documents(no_docs, items).count() == 0
    assert lexical.rank_documents(odd_docs, items.where("false")).count() == 0
    assert lexical.rank_documents(odd_docs, items).where("item_id = 4 and rank = 1").count() == 1


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    got = [tuple(r) for r in lexical.op11_ranked_search(spark, sf_dir).collect()]
    assert sorted(got) == sorted(slow_rank(docs, items))
