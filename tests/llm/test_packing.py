"""Packing: pieces by the tokenizer itself, gapless sequences, and few of them."""

from __future__ import annotations

import collections
import random
import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from holdfast.llm import packing


@pytest.mark.parametrize("most_open", [20_000, 1])
def test_pieces_and_sequences(odd_docs, most_open):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    total = 0
    for r in odd_docs.collect():
        ids = [*whole.encode(r.text or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        for number, (start, size) in enumerate(packing.pieces_of(len(ids), 2_048)):
            raw = struct.pack(f"<{size}I", *ids[start:start + size])
            want[(r.doc_id, number, start, size, zlib.crc32(raw))] += 1
    rows = packing.pack(odd_docs, fan_in=2, most_open=most_open).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 2_048
    if most_open > 1:
        assert len(bins) <= -(-total // 2_048) + 1


def test_best_fit_is_dense():
    rng = random.Random(2)
    sizes = [rng.randrange(1, 900) for _ in range(3_000)]
    bins, offsets, fills = packing.best_fit(sizes, 2_048)
    assert len(fills) <= -(-sum(sizes) // 2_048) + 1 and max(fills) <= 2_048
    assert packing.best_fit([], 8) == ([], [], [])


@pytest.mark.parametrize("n", [1, 2_047, 2_048, 2_049, 4_096, 5_000])
def test_only_the_first_piece_is_short(n):
    pieces = packing.pieces_of(n, 2_048)
    assert sum(size for _, size in pieces) == n and all(size == 2_048 for _, size in pieces[1:])


def test_empty(no_docs):
    assert packing.pack(no_docs).count() == 0


def test_bins_of_a_crowded_group_all_go_on(spark):
    """Dealt to many hands, hundreds of half-full bins still end in about as few sequences as in one."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    docs = spark.createDataFrame([(i, " ".join(words[(i + k) % 10] for k in range(300 + i % 400))) for i in range(400)], "doc_id long, text string").repartition(40)
    one, many = (packing.pack(docs, fan_in=4, most_open=most) for most in (20_000, 12))
    rows = many.collect()
    fills = collections.Counter()
    for r in rows:
        fills[r.sequence_id] += r.length
    least = -(-sum(fills.values()) // 2_048)
    assert len(rows) == 400 and max(fills.values()) <= 2_048
    assert len({r.sequence_id for r in one.collect()}) <= least + 40 and len(fills) <= least + 60
