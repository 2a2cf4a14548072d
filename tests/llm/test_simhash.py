"""SimHash near-duplicates against all pairs by brute force."""

from __future__ import annotations

import random

import pytest
import xxhash

from holdfast.llm import components, simhash


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(values, budget=2):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in values:
        for b in values:
            if a < b and bin(a ^ b).count("1") <= budget:
                parent[root(a)] = root(b)
    return {v: root(v) for v in values}


def test_documents(spark, odd_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    rows = odd_docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    prints = {(r.doc_id, slow_fingerprint(r.text)) for r in rows}
    assert {(g.doc_id, g.fp % (1 << 64)) for g in got} == prints
    roots = slow_components({p for _, p in prints})
    least = {}
    for doc_id, p in prints:
        if doc_id is not None:
            least[roots[p]] = min(least.get(roots[p], doc_id), doc_id)
    assert all(g.component_id == least.get(roots[g.fp % (1 << 64)]) for g in got)


@pytest.mark.parametrize("dense", [512, 2])
def test_chains_lose_no_link(spark, dense):
    rng = random.Random(4)
    values = set()
    for _ in range(60):
        v = rng.getrandbits(64)
        values.add(v)
        for _ in range(rng.randrange(5)):
            for bit in rng.sample(range(64), rng.randrange(1, 4)):
                v ^= 1 << bit
            values.add(v)
    values = sorted(values)
    fps = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, i) for i, v in enumerate(values)], "fp long, rep long")
    parts = {r.node: r.component for r in components.connected(simhash.links(fps, dense=dense), "a", "b").collect()}
    roots = slow_components(values)
    least = {}
    for i, v in enumerate(values):
        least.setdefault(roots[v], i)
    assert all(parts.get(i, i) == least[roots[v]] for i, v in enumerate(values))


def test_long_path_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components.connected(edges, "a", "b").collect()}
    assert {got[i] for i in range(201)} == {0} and got[501] == 500


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
