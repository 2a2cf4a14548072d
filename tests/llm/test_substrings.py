"""Repeated strings against every window by brute force; suffix arrays against sorting."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from holdfast.llm import substrings, suffixes
from holdfast.llm.blocks import write_blocks
from holdfast.llm.routes import Route
from holdfast.llm.substrings import remove_repeats


def slow(rows):
    first = {}
    rows = [((1 << 63) - 1 if i is None else i, (t or "").encode(), i) for i, t in rows]
    for i, t, _ in rows:
        for s in range(len(t) - 49):
            first[t[s:s + 50]] = min(first.get(t[s:s + 50], i), i)
    out = []
    for i, t, name in rows:
        gone = bytearray(len(t))
        for s in range(len(t) - 49):
            if first[t[s:s + 50]] < i:
                gone[s:s + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        out.append((str(name), len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def fast(df, **sizes):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept.decode()) for r in remove_repeats(df, keep="digest", **sizes).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    letters = "abcde ü"
    base = ["".join(rng.choices(letters, k=400)) for _ in range(6)]
    out = []
    for i in range(60):
        text = "".join(rng.choices(letters, k=rng.randint(0, 200)))
        for _ in range(rng.randint(0, 3)):
            a = rng.randint(0, 300)
            text += rng.choice(base)[a:a + rng.randint(20, 150)] + rng.choice(["", "q", "zz"])
        out.append((i if i % 7 else i // 2, text))
    return out + [(100, "ab" * 200), (101, "ab" * 180), (102, "x" * 500), (103, "x" * 49), (104, "x" * 50), (None, base[0]), (50, base[0]), (51, base[0])]


@pytest.mark.parametrize("sizes", [
    {}, {"block_bytes": 500, "least_shards": 3, "shard_bytes": 1_000}, {"block_bytes": 300, "hot_blocks": 2}, {"chunk": 2, "hot_blocks": 1, "block_bytes": 200},
    {"chunk": 7, "block_bytes": 700}, {"direct": 2, "least_shards": 40, "block_bytes": 300}, {"direct": 0, "least_shards": 5, "hot_blocks": 1, "block_bytes": 500}])
def test_windows(spark, rows, sizes):
    assert fast(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), **sizes) == slow(rows)


def test_a_phrase_with_many_surroundings_is_spread(spark):
    rng = random.Random(8)
    phrase = "please accept our cookies to go on reading"
    letters = [chr(c) for c in range(97, 123)]
    rows = [(i, "".join(rng.choices(letters, k=60)) + phrase + "".join(rng.choices(letters, k=60))) for i in range(40)]
    rows += [(i, "x" + rows[i % 3][1]) for i in range(40, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert fast(df, hot_contexts=10) == slow(rows) == fast(df)

    largest = {}
    for bound in (10, 1_000):
        shards = 2
        blocks = write_blocks(df, 1_000)
        counted = substrings._count_anchors(blocks, shards, 50, 24, Route(0)).toPandas()
        marks = [substrings._shared_anchors(4_096, bound, Route(0))(part) for _, part in counted.groupby("target")]
        held = {}
        for row in blocks.collect():
            ids, texts, _ = substrings.unsqueeze(row.body)
            mine = {int(s): substrings.unsqueeze(m) for t in marks for b, s, m in t.itertuples(index=False) if b == row.block}
            contents, keys, _, _ = substrings.entries(substrings.Anchors(ids, texts), mine, shards)
            for content, key in zip(contents, keys.tolist(), strict=True):
                held.setdefault(key, set()).add(content)
        largest[bound] = max(map(len, held.values()))
    assert largest[10] <= 10 < 40 <= largest[1_000]


def test_odd_texts(odd_docs, no_docs):
    assert fast(odd_docs) == slow([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert remove_repeats(no_docs).count() == 0


def test_suffix_arrays():
    rng = np.random.default_rng(1)
    for _ in range(100):
        text = rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(1, 300))).astype(np.uint8)
        order, _ = suffixes.suffix_array(text, 20)
        data = text.tobytes()
        assert [data[i:i + 20] for i in order] == sorted(data[i:i + 20] for i in range(len(data)))
        prefix = suffixes.common_prefixes(text, order, 20, lanes=int(rng.integers(1, 9)))
        for k in range(1, len(data)):
            a, b = data[order[k]:][:20], data[order[k - 1]:][:20]
            assert prefix[k] == next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_routes_bring_everything_in_few_rows(spark):
    """A hundred sources with a row for each of a hundred targets: ten rows a source, ten a target."""
    import pandas as pd

    for route, most in ((Route.to(100, direct=100), 10_000), (Route.to(100, direct=99), 1_000)):
        sent = spark.range(100).repartition(5).mapInPandas(
            lambda frames, route=route: (route.frame([(t, int(s), f"{s}-{t}".encode()) for t in range(100)]) for f in frames for s in f["id"]), route.schema)
        assert sent.count() <= most
        def told(rows):
            sources, bodies = Route.arrived(rows)
            return pd.DataFrame({"target": [int(rows.target.iloc[0])], "n": [len(set(zip(sources, bodies)))],
                                 "right": [all(b == f"{s}-{rows.target.iloc[0]}".encode() for s, b in zip(sources, bodies))]})
        got = route.grouped(sent).applyInPandas(told, "target long, n long, right boolean").collect()
        assert {(r.n, r.right) for r in got} == {(100, True)} and len(got) == 100
