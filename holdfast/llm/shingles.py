"""Hashes of word shingles."""

from __future__ import annotations

SEED = 42


def shingle_hashes(data: bytes, width: int):
    """XXH64 of every word shingle of ``data`` (lower-cased here), repeats included; fewer words are one shingle."""
    import numpy as np
    import xxhash

    words = data.lower().split()
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, SEED)] if words else [], dtype="<u8")
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = (starts + sizes)[width - 1:].tolist()
    return np.array([digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends)], dtype="<u8")
