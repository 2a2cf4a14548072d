"""Spelling variants: tiles, neighbours and forms against plain edit checks."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from holdfast.llm import spelling


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i:] == b[i + 1:] or a[i + 1:] == b[i + 1:]


def slow_words(docs):
    counts: Counter = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def slow_groups(words, ratio=10):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * n else None
    rows = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return rows


def variants(rng, letters, base, many):
    words = set()
    for _ in range(many):
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(1, base)))
        words.add(w)
        for _ in range(3):
            i = rng.randrange(len(w) + 1)
            words |= {w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i + 1:]}
    return words - {""}


@pytest.mark.parametrize(("letters", "base", "many"), [("ab", 9, 60), ("abcdéß", 14, 150), ("xy漢😀", 90, 40)])
def test_neighbours_by_brute_force(spark, letters, base, many):
    rng = random.Random(base)
    words = {w: rng.choice([2, 3, 30, 400, 5000]) for w in variants(rng, letters, base, many)}
    counts = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert {tuple(r) for r in spelling.variant_groups(counts).collect()} == slow_groups(words)


def test_small_tiles_and_batches_change_nothing(monkeypatch):
    """One big group, cut into blocks, and groups that go over the end of a batch."""
    words = sorted({f"{a}{b}tail" for a in "abcdefghij" for b in "klmnopqrst"})
    rows = pa.table({"length": [6] * 100 + [6] * 3, "window": [0] * 100 + [1] * 3, "key": [1] * 100 + [2] * 3,
                     "word": words + ["aktail", "akxail", "akyyil"], "n": [5] * 103})
    whole = [b.to_pylist() for b in spelling._neighbours(iter(rows.to_batches()))]
    monkeypatch.setattr(spelling, "BLOCK", 7)
    cut = [b.to_pylist() for b in spelling._neighbours(iter(rows.to_batches(max_chunksize=9)))]
    assert sum(whole, []) == sum(cut, [])
    assert {r["n_near"] for r in sum(whole, [])[:100]} == {18}


def test_chains_and_ties(spark):
    words = {"kettles": 5000, "kettlex": 400, "kettlxx": 30, "kettxxx": 2, "bettles": 5000, "nothing": 9, "zzzzzzz": 3}
    got = {r.word: r for r in spelling.variant_groups(spark.createDataFrame(list(words.items()) + [(None, 9), ("once", 1)], "word string, n long")).collect()}
    assert set(got) == set(words)
    assert got["kettxxx"].root == "kettles" and got["kettlxx"].form == "kettlex" and got["kettles"].form is None and got["kettles"].n_near == 2
    assert {tuple(r) for r in got.values()} == slow_groups(words)


def test_counts_are_added_in_parts(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for held in (1, 1000):
        got = {r.word: r.n for r in spelling.word_counts(odd_docs, held=held).where("n >= 2").collect()}
        assert got == slow_words(docs)
    assert spelling.variant_groups(spelling.word_counts(no_docs)).count() == 0
    assert spelling.variant_groups(spelling.word_counts(odd_docs)).count() == len(slow_words(docs))


def test_very_long_words(spark):
    long = "abcdefghij" * 2_000
    words = {long: 50, long[:9_999] + long[10_000:]: 2, long[:5] + "X" + long[6:]: 3, long + "!!": 4}
    counts = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {tuple(r) for r in spelling.variant_groups(counts).collect()} == slow_groups(words)


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    words = slow_words(docs)
    got = {tuple(r) for r in spelling.op13_spelling_variants(spark, sf_dir).collect()}
    by_length: dict = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    assert {g[0]: g[3] for g in got} == words
    picked = [g for i, g in enumerate(sorted(got)) if i % 20 == 0 or g[1]]
    for word, form, _, n, n_near, form_n in picked:
        near = [v for k in (-1, 0, 1) for v in by_length.get(len(word) + k, []) if one_edit(word, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        best = best if best and words[best] >= 10 * n else None
        assert (n_near, form, form_n) == (len(near), best, words.get(best))
    forms = {g[0]: g[1] for g in got}
    for word, _, root, *_ in got:
        while forms[word]:
            word = forms[word]
        assert word == root
