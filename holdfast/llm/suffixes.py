"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai common prefixes, to a bounded depth."""

from __future__ import annotations

import numpy as np


def words_at(padded: np.ndarray, n: int, at: int = 0) -> np.ndarray:
    """The eight bytes from each of ``n`` places on, as big-endian numbers; ``padded`` reaches far enough."""
    return np.ndarray((n,), dtype=">u8", buffer=padded.data, offset=at, strides=(1,))


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` bytes at least, and the group of each.

    Suffixes are first ordered by eight bytes. Then only groups that are still mixed are refined, by the
    groups of the suffixes that start where the known prefix ends, which doubles what is known.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    keys = words_at(padded, n).astype(np.uint64)
    order = np.argsort(keys, kind="stable").astype(np.int64)
    sorted_keys = keys[order]
    new = np.empty(n, dtype=bool)
    new[:1] = True
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    # the zeros behind the end are told from zeros in the text only by length, which depth-bounded users never see
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = first
    known = 8
    while known < depth:
        single = new & np.append(new[1:], True)
        mixed = np.flatnonzero(~single)
        if not len(mixed):
            break
        suffixes = order[mixed]
        groups = rank[suffixes]
        behind = rank[np.minimum(suffixes + known, n)]
        by = np.argsort(groups * (n + 1) + behind + 1, kind="stable")
        suffixes, groups, behind = suffixes[by], groups[by], behind[by]
        order[mixed] = suffixes
        starts = np.empty(len(mixed), dtype=bool)
        starts[:1] = True
        starts[1:] = (groups[1:] != groups[:-1]) | (behind[1:] != behind[:-1])
        new[mixed] |= starts
        rank[suffixes] = np.maximum.accumulate(np.where(starts, mixed, 0))
        known *= 2
    return order, rank[:n]


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int, lanes: int = 8_192) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order``, up to ``cap``, by Kasai's walk.

    The walk goes through the text and keeps all but one byte of the prefix it had one place before. It runs
    on many stretches of the text in step; each of them starts without a prefix. ``order`` may leave suffixes
    in any order that agree in more than ``cap`` bytes; the prefix is kept only where that did no harm.
    """
    n = len(text)
    prefix = np.zeros(n, dtype=np.int32)
    if n < 2:
        return prefix
    before = np.empty(n, dtype=np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    place = np.empty(n + 1, dtype=np.int64)
    place[order] = np.arange(n)
    place[n] = -1
    padded = np.concatenate([text, np.zeros(cap + 16, np.uint8)])
    eight = np.ndarray((n + cap + 8,), dtype="<u8", buffer=padded.data, strides=(1,))
    stretch = -(-n // min(lanes, n))
    places = np.arange(0, n, stretch)
    have = np.zeros(len(places), dtype=np.int64)
    for _ in range(stretch):
        other = before[places]
        going = np.flatnonzero(other >= 0)
        have[other < 0] = 0
        while len(going):
            p, q, h = places[going], other[going], have[going]
            differ = eight[p + h] ^ eight[q + h]
            low = differ & (~differ + np.uint64(1))
            same = np.where(differ == 0, 8, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) // 8)
            h = np.minimum(np.minimum(h + same, cap), n - np.maximum(p, q))
            have[going] = h
            going = going[(differ == 0) & (h < cap) & (h < n - np.maximum(p, q))]
        prefix[places] = have
        ordered = place[np.maximum(other, 0) + 1] < place[places + 1]
        have = np.where((other >= 0) & ordered, np.maximum(have - 1, 0), 0)
        places = places + 1
        if places[-1] >= n:
            places, have = places[:-1], have[:-1]
    return prefix[order]
