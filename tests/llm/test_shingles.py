"""Shingle hashes."""

from __future__ import annotations

import xxhash

from holdfast.llm.shingles import shingle_hashes


def test_hashes_of_all_shingles():
    assert shingle_hashes(b"A b  c\nd", 3).tolist() == [xxhash.xxh64_intdigest(s, 42) for s in (b"a b c", b"b c d")]
    assert shingle_hashes(b"a b", 3).tolist() == [xxhash.xxh64_intdigest(b"a b", 42)] and len(shingle_hashes(b" ", 3)) == 0
