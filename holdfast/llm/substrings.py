"""Removal of byte strings that an earlier document has: suffix arrays over shards of candidate contexts.

Every string of LENGTH bytes holds the anchor it shares with its copies: the k-gram of least hash among its
own. Anchors are counted first, as packed hashes. Contexts of anchors that several documents have are then
dealt to shards by anchor, so that copies of a string meet. A shard builds suffix arrays with common prefixes
over its contexts and finds the smallest doc_id of every string; arrays of one anchor are merged by binary
search. Documents travel as compressed blocks, and each block applies what the shards found.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.blocks import BLOCK_BYTES, squeeze, unsqueeze, write_blocks
from holdfast.llm.common import give_back, map_rows, query, table
from holdfast.llm.routes import DIRECT, Route
from holdfast.session import drop_path, fresh_path, write_table

LENGTH = 50
GRAM = 24
SHARD_BYTES = 8 << 20
LEAST_SHARDS = 64
CHUNK = 8_192
PORTION = 1 << 20
FACTOR = 0x9E3779B97F4A7C15
HOT_BLOCKS = 4_096
HOT_CONTEXTS = 65_536
LAST_ID = (1 << 63) - 1


def _sliding(pick, values, width: int):
    span, out = 1, values
    while span * 2 <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    return pick(out[: len(out) - (width - span)], out[width - span:]) if span < width else out


class Laid:
    """The documents of a block end to end."""

    def __init__(self, ids: list, texts: list[bytes], length: int = LENGTH):
        import numpy as np

        self.length = length
        self.ids = np.array([LAST_ID if i is None else i for i in ids], dtype=np.int64)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.text = b"".join(texts)


class Anchors(Laid):
    """The documents of a block, and the places and hashes of their anchors."""

    def __init__(self, ids: list, texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
        import numpy as np

        super().__init__(ids, texts, length)
        found = [self._in(first, last, gram) for first, last in self.portions()]
        self.places = np.concatenate([places for places, _ in found] + [np.zeros(0, np.int64)])
        self.hashes = np.concatenate([hashes for _, hashes in found] + [np.zeros(0, np.uint64)])
        self.owner = np.searchsorted(self.ends, self.places, side="right")

    def portions(self, size: int = PORTION):
        """Documents, first and last exclusive, of about ``size`` bytes together, which bounds the arrays made of them."""
        first = 0
        for last in range(1, len(self.ids) + 1):
            if last == len(self.ids) or self.ends[last] - self.starts[first] > size:
                yield first, last
                first = last

    def _in(self, first: int, last: int, gram: int):
        """Places and hashes of the anchors of some documents."""
        import numpy as np

        begin, length = int(self.starts[first]), self.length
        text = self.text[begin: int(self.ends[last - 1])]
        n = len(text)
        if n < length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        hashes = _gram_hashes(text, gram)
        whole = np.zeros(n - length + 1, dtype=bool)  # places where a string of the full length starts
        for lo, hi in zip((self.starts[first:last] - begin).tolist(), (self.ends[first:last] - begin).tolist(), strict=True):
            if hi - lo >= length:
                whole[lo: hi - length + 1] = True
        width = length - gram + 1
        least = np.where(whole, _sliding(np.minimum, hashes, width), 0)
        edge = np.zeros(width - 1, dtype=np.uint64)
        reached = _sliding(np.maximum, np.concatenate([edge, least, edge]), width)
        places = np.flatnonzero((reached == hashes) & (hashes > 0))
        return places + begin, hashes[places]

    def distinct(self):
        """Sorted different hashes, and for each anchor its place among them."""
        import numpy as np

        return np.unique(self.hashes, return_inverse=True)

    def shared_here(self, n: int, inverse):
        """Which different hashes at least two documents of this block have, by doc_id."""
        import numpy as np

        low, high = np.full(n, LAST_ID), np.full(n, -LAST_ID)
        np.minimum.at(low, inverse, self.ids[self.owner])
        np.maximum.at(high, inverse, self.ids[self.owner])
        return low < high

    def contexts_of(self, chosen):
        """First and last place, exclusive, of what strings that hold these anchors can reach in their documents."""
        import numpy as np

        reach = self.length - GRAM if self.length > GRAM else 0
        owner = self.owner[chosen]
        return np.maximum(self.places[chosen] - reach, self.starts[owner]), np.minimum(self.places[chosen] + self.length, self.ends[owner])

    def different_contexts(self, n: int, inverse):
        """How many different contexts each of the different hashes has in this block."""
        import numpy as np

        counts = np.bincount(inverse, minlength=n)
        again = np.flatnonzero(counts[inverse] > 1)
        if len(again):
            mixed = np.concatenate([self._digests(first, last, again) for first, last in self.portions()])
            order = np.lexsort((mixed, inverse[again]))
            of, content = inverse[again][order], mixed[order]
            new = np.append(True, (of[1:] != of[:-1]) | (content[1:] != content[:-1]))
            counts = np.where(counts > 1, np.bincount(of[new], minlength=n), counts)
        return counts


    def _digests(self, first: int, last: int, chosen):
        """Hashes of the contexts of those of the chosen anchors (in order) that lie in some documents; equal texts agree wherever they lie."""
        import numpy as np

        begin, end = int(self.starts[first]), int(self.ends[last - 1])
        mine = chosen[np.searchsorted(self.places[chosen], begin): np.searchsorted(self.places[chosen], end)]
        lows, highs = self.contexts_of(mine)
        text = np.frombuffer(self.text, np.uint8, end - begin, begin) if end > begin else np.zeros(0, np.uint8)
        powers = np.cumprod(np.full(len(text) + 1, FACTOR, dtype=np.uint64))
        until = np.zeros(len(text) + 1, dtype=np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=until[1:])
        back = np.cumprod(np.full(len(text) + 1, pow(FACTOR, -1, 1 << 64), dtype=np.uint64))
        sums = (until[highs - begin] - until[lows - begin]) * back[lows - begin]
        return (sums ^ (sums >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + (highs - lows).astype(np.uint64)


def _gram_hashes(text: bytes, gram: int):
    import numpy as np

    n = len(text) - gram + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for at in range(0, gram, 8):
        step = min(at, gram - 8)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        mixed += np.ndarray((n,), dtype="<u8", buffer=text, offset=step, strides=(1,))
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))) | np.uint64(1)


def _short(hashes):
    """Five bytes of each hash; with the shard number they tell hashes apart well enough to pick candidates."""
    import numpy as np

    return (hashes >> np.uint64(24)).astype(np.uint64)


def _five(values) -> bytes:
    import numpy as np

    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unfive(data: bytes):
    import numpy as np

    out = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _by_shard(distinct, shards: int):
    """Order of the different hashes by shard, and where each shard starts in it."""
    import numpy as np

    shard = (distinct >> np.uint64(1)) % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def _count_anchors(blocks: DataFrame, shards: int, length: int, gram: int, route: Route) -> DataFrame:
    def each(block, body):
        import numpy as np

        ids, texts, _ = unsqueeze(body)
        found = Anchors(ids, texts, length, gram)
        distinct, inverse = found.distinct()
        here = found.shared_here(len(distinct), inverse)
        contexts = found.different_contexts(len(distinct), inverse).astype(np.uint32)
        order, cuts = _by_shard(distinct, shards)
        for shard in np.flatnonzero(np.diff(cuts)).tolist():
            part = order[cuts[shard]: cuts[shard + 1]]
            more = np.flatnonzero(contexts[part] > 1).astype(np.uint32)  # the others have one
            yield shard, block, squeeze((_five(_short(distinct[part])), np.packbits(here[part]).tobytes(), more, contexts[part][more]))

    def run(rows):
        for block, body in rows:
            yield from route.leaving(each(block, body))
            give_back()

    return map_rows(blocks.select("block", "body"), route.schema, run)


def _shared_anchors(hot_blocks: int, hot_contexts: int, back: Route):
    """For each block, which of its hashes in this shard several documents have (1) and which are hot (2).

    Hot are those that many blocks have, and those whose different contexts, added up over the blocks, are many.
    """

    def run(rows):
        import numpy as np

        sources, bodies = Route.arrived(rows)
        parts = [unsqueeze(b) for b in bodies]
        lists = [_unfive(h) for h, _, _, _ in parts]
        where = np.cumsum([0, *map(len, lists)])
        values = np.concatenate(lists)
        here = np.concatenate([np.unpackbits(np.frombuffer(s, np.uint8), count=len(x)) for (_, s, _, _), x in zip(parts, lists, strict=True)])
        _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
        contexts = counts.copy()
        for lo, (_, _, more, times) in zip(where, parts):
            np.add.at(contexts, inverse[lo + more.astype(np.int64)], times.astype(np.int64) - 1)
        many = counts[inverse]
        shared = (many > 1) | (here > 0)
        mark = shared.astype(np.uint8) + (shared & ((many > hot_blocks) | (contexts[inverse] > hot_contexts)))
        shard = int(rows.target.iloc[0])
        return back.frame((block, shard, squeeze(mark[a:b])) for block, a, b in zip(sources, where, where[1:]))

    return run


def entries(found: Anchors, marks: dict[int, object], shards: int):
    """Contexts to look up: a list of different ``(content, key)`` and, for each place, ``(place, number)``.

    The context of an anchor is what strings that hold it can reach. A hot anchor's strings go one by one,
    with a key of their own, so that they spread over the shards.
    """
    import numpy as np
    import xxhash

    distinct, inverse = found.distinct()
    order, cuts = _by_shard(distinct, shards)
    mark = np.zeros(len(distinct), dtype=np.uint8)
    for shard, got in marks.items():
        mark[order[cuts[shard]: cuts[shard + 1]]] = got
    text, length = found.text, found.length
    state = mark[inverse]
    numbers: dict[bytes, int] = {}

    def numbered(lows, highs):
        return np.array([numbers.setdefault(text[lo:hi], len(numbers)) for lo, hi in zip(lows.tolist(), highs.tolist(), strict=True)], dtype=np.int64)

    chosen, hot = np.flatnonzero(state == 1), np.flatnonzero(state > 1)
    lows, highs = found.contexts_of(chosen)
    which = numbered(lows, highs)
    keys = np.empty(len(numbers), dtype=np.uint64)
    keys[which] = found.hashes[chosen]
    first, last = found.contexts_of(hot)
    counts = np.maximum(last - first - length + 1, 0)
    each = np.repeat(first, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    strings = numbered(each, each + length)
    contents = list(numbers)
    own = [xxhash.xxh64_intdigest(c) for c in contents[len(keys):]]
    return contents, np.concatenate([keys, np.array(own, dtype=np.uint64)]), np.concatenate([lows, each]), np.concatenate([which, strings])


def _least_ids(found: Laid, places, which, n: int):
    import numpy as np

    owners = found.ids[np.searchsorted(found.ends, places, side="right")]
    least = np.full(n, LAST_ID, dtype=np.int64)
    np.minimum.at(least, which, owners)
    return owners, least


def _send_contexts(shards: int, length: int, gram: int, route: Route):
    """A block's different contexts, by shard; and for itself, under a number below zero, where they are."""

    def each(blocks, marks):
        import numpy as np

        ids, texts, _ = unsqueeze(blocks.body.iloc[0])
        found, block = Anchors(ids, texts, length, gram), int(blocks.block.iloc[0])
        got = {shard: unsqueeze(mark) for shard, mark in zip(*Route.arrived(marks), strict=True)}
        contents, keys, places, which = entries(found, got, shards)
        _, least = _least_ids(found, places, which, len(contents))
        target = (keys >> np.uint64(1)) % np.uint64(shards)
        order = np.lexsort((keys, target))
        cuts = np.searchsorted(target[order], np.arange(shards + 1))
        for shard in np.flatnonzero(np.diff(cuts)).tolist():
            part = order[cuts[shard]: cuts[shard + 1]]
            rows = [contents[i] for i in part.tolist()]
            yield shard, block, squeeze((
                part.astype(np.uint32), keys[part], least[part], np.array([len(r) for r in rows], dtype=np.int32), b"".join(rows)))
        sizes = np.array([len(c) for c in contents], dtype=np.uint32)
        yield -1 - (block * 0x9E3779B1 >> 9) % (1 << 30), block, squeeze((places.astype(np.uint32), which.astype(np.uint32), sizes))

    def run(blocks, marks):
        made = route.frame(each(blocks, marks) if len(blocks) else [])
        give_back()
        return made

    return run


def smallest_ids(contents: list[bytes], ids, length: int = LENGTH):
    """For contexts and their doc_ids: sorted different strings of ``length`` bytes, the smallest doc_id of
    each, and for every string of every context (in order) its place among them. One suffix array."""
    import numpy as np

    from holdfast.llm.suffixes import common_prefixes, suffix_array

    text = np.frombuffer(b"".join(contents), dtype=np.uint8)
    sizes = np.array([len(c) for c in contents], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    counts = np.maximum(sizes - length + 1, 0)
    total = int(counts.sum())
    inner = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    places = np.repeat(starts, counts) + inner
    owners = np.repeat(np.asarray(ids, dtype=np.int64), counts)
    order, _ = suffix_array(text, length)
    prefix = common_prefixes(text, order, length)
    group_of = np.cumsum(prefix < length) - 1  # by place in the order
    group = np.empty(len(text), dtype=np.int64)
    group[order] = group_of
    groups, at = np.unique(group[places], return_inverse=True)
    least = np.full(len(groups), LAST_ID, dtype=np.int64)
    np.minimum.at(least, at, owners)
    some = np.zeros(len(groups), dtype=np.int64)
    some[at] = places
    lanes = np.lib.stride_tricks.sliding_window_view(text, length) if len(text) >= length else np.zeros((0, length), np.uint8)
    return lanes, some, least, at


def _merge_sorted(lists, length: int):
    """Sorted ``(strings, ids)`` lists of one anchor into one, each found in the other by binary search."""
    import numpy as np

    while len(lists) > 1:
        merged = []
        for (a, low_a), (b, low_b) in zip(lists[::2], lists[1::2]):
            spot = np.minimum(np.searchsorted(a, b), max(len(a) - 1, 0))
            same = a[spot] == b
            np.minimum.at(low_a, spot[same], low_b[same])
            strings, ids = np.concatenate([a, b[~same]]), np.concatenate([low_a, low_b[~same]])
            order = np.argsort(strings, kind="stable")
            merged.append((strings[order], ids[order]))
        lists = merged + ([lists[-1]] if len(lists) % 2 else [])
    return lists[0]


def earlier_strings(contents: list[bytes], keys, ids, length: int = LENGTH, chunk: int = CHUNK):
    """For each context, a bit for every string of it that another context has under a smaller doc_id.

    Equal contexts count once, by their smallest doc_id; under all others every string is an earlier one.
    Contexts that are the only one of their key are done with that. The others are taken in the order of their
    keys, in chunks of about ``chunk`` that end where a key ends. A key with more contexts than that has several
    chunks, whose strings are merged by binary search.
    """
    import numpy as np

    numbers: dict[bytes, int] = {}
    same = np.fromiter((numbers.setdefault(c, i) for i, c in enumerate(contents)), dtype=np.int64, count=len(contents))
    least = np.full(len(contents), LAST_ID, dtype=np.int64)
    np.minimum.at(least, same, ids)
    sizes = np.array([len(c) for c in contents], dtype=np.int64)
    every = (np.uint64(1) << np.maximum(sizes - length + 1, 0).astype(np.uint64)) - np.uint64(1)
    first = np.flatnonzero(same == np.arange(len(contents)))
    _, family, many = np.unique(keys[first], return_inverse=True, return_counts=True)
    first = first[many[family] > 1]
    bits = np.zeros(len(contents), dtype=np.uint64)
    bits[first] = _earlier_among([contents[i] for i in first.tolist()], keys[first], least[first], length, chunk)
    return np.where(ids > least[same], every, bits[same])


def _earlier_among(contents: list[bytes], keys, ids, length: int, chunk: int):
    import numpy as np

    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    bounds = np.append(np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])), len(order)).tolist()
    families: list[list[tuple[int, int]]] = []
    start = 0
    for lo, hi in zip(bounds, bounds[1:]):
        if hi - lo > chunk:
            if start < lo:
                families.append([(start, lo)])
            families.append([(x, min(x + chunk, hi)) for x in range(lo, hi, chunk)])
            start = hi
        elif hi - start > chunk:
            families.append([(start, lo)])
            start = lo
    if start < len(order):
        families.append([(start, len(order))])
    bits = np.zeros(len(contents), dtype=np.uint64)
    for family in families:
        held = []
        for lo, hi in family:
            part = order[lo:hi]
            rows = [contents[i] for i in part.tolist()]
            lanes, some, least, at = smallest_ids(rows, ids[part], length)
            strings = None
            if len(family) > 1:
                strings = np.ascontiguousarray(lanes[some]).view(f"S{length}").ravel()
                by = np.argsort(strings, kind="stable")
                back = np.empty(len(by), dtype=np.int64)
                back[by] = np.arange(len(by))
                strings, least, at = strings[by], least[by], back[at]
            held.append((part, rows, strings, least, at))
        whole = _merge_sorted([(s, low.copy()) for _, _, s, low, _ in held], length) if len(family) > 1 else None
        for part, rows, strings, least, at in held:
            if whole is not None:
                least = whole[1][np.searchsorted(whole[0], strings)]
            counts = np.array([max(len(r) - length + 1, 0) for r in rows], dtype=np.int64)
            inner = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
            earlier = least[at] < np.repeat(ids[part], counts)
            np.bitwise_or.at(bits, np.repeat(part, counts)[earlier], np.uint64(1) << inner[earlier].astype(np.uint64))
    return bits


def _search_shard(length: int, chunk: int, back: Route):
    """Bits of a shard's contexts, by block; rows under a number below zero go back to their block as they are."""

    def run(rows):
        import numpy as np

        target = int(rows.target.iloc[0])
        sources, bodies = Route.arrived(rows)
        if target < 0:
            return back.frame((block, -1, body) for block, body in zip(sources, bodies, strict=True))
        parts = [unsqueeze(c) for c in bodies]
        contents = []
        for _, _, _, sizes, text in parts:
            ends = np.cumsum(sizes)
            contents += [text[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]
        bits = earlier_strings(contents, np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]), length, chunk)
        cuts = np.cumsum([0, *(len(p[0]) for p in parts)])
        answers = ((p[0], bits[a:b]) for p, a, b in zip(parts, cuts, cuts[1:]))
        del contents
        give_back()
        return back.frame((block, target, squeeze((names[got > 0], got[got > 0]))) for block, (names, got) in zip(sources, answers, strict=True))

    return run


def removed_bytes(found: Laid, places, which, sizes, answers: list):
    """A flag for each byte of the block: some string over it starts in a document with a smaller doc_id.

    Context ``which[i]`` of the block lies at ``places[i]`` and has ``sizes[which[i]]`` bytes.
    """
    import numpy as np

    n = len(found.text)
    change = np.zeros(n + 1, dtype=np.int32)
    if len(places):
        owners, least = _least_ids(found, places, which, len(sizes))
        bits = np.zeros(len(sizes), dtype=np.uint64)
        for numbers, got in answers:
            bits[numbers] |= got
        later = owners > least[which]  # another document of this block has the same context
        np.add.at(change, places[later], 1)
        np.add.at(change, places[later] + sizes[which[later]], -1)
        mine = np.flatnonzero(~later & (bits[which] > 0))
        for bit in range(int(sizes.max()) - found.length + 1):
            hit = places[mine[(bits[which[mine]] >> np.uint64(bit)) & np.uint64(1) > 0]] + bit
            np.add.at(change, hit, 1)
            np.add.at(change, hit + found.length, -1)
    return np.cumsum(change[:n], out=change[:n]) > 0


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, extra string"


def _apply(length: int, keep: str):
    def run(blocks, told):
        import numpy as np
        import pandas as pd

        out = []
        if len(blocks):
            ids, texts, extras = unsqueeze(blocks.body.iloc[0])
            found = Laid(ids, texts, length)
            answers = [(source, unsqueeze(body)) for source, body in zip(*Route.arrived(told), strict=True)]
            places, which, sizes = (x.astype(np.int64) for x in next(a for source, a in answers if source < 0))
            gone = removed_bytes(found, places, which, sizes, [a for source, a in answers if source >= 0])
            text = np.frombuffer(found.text, dtype=np.uint8)
            for doc_id, lo, hi, more in zip(ids, found.starts.tolist(), found.ends.tolist(), extras, strict=True):
                mine = gone[lo:hi]
                spans = int(mine[:1].sum()) + int((mine[1:] & ~mine[:-1]).sum())
                kept = text[lo:hi][~mine].tobytes() if spans else found.text[lo:hi]
                if keep == "digest":
                    kept = hashlib.sha256(kept).hexdigest().encode()
                elif keep == "text":
                    kept = kept.decode("utf-8", "ignore").encode()
                out.append((doc_id, hi - lo, int(mine.sum()), spans, kept, more))
        give_back()
        rows = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "extra"])
        return rows.astype({"doc_id": "Int64"})

    return run


def remove_repeats(docs: DataFrame, extra: str | None = None, keep: str = "bytes", length: int = LENGTH, block_bytes: int = BLOCK_BYTES,
                   shard_bytes: int = SHARD_BYTES, least_shards: int = LEAST_SHARDS, chunk: int = CHUNK, hot_blocks: int = HOT_BLOCKS,
                   hot_contexts: int = HOT_CONTEXTS, direct: int = DIRECT) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept, extra)`` for every row of ``docs``.

    Each byte that lies in a string of ``length`` bytes which also starts in a row with a smaller doc_id is
    removed; ``kept`` is the rest: its bytes, with ``keep="text"`` the whole characters among them, with
    ``keep="digest"`` the hex digits of its SHA-256. Rows that share a doc_id never remove from each other. A row without doc_id comes after all others. Null and short
    texts keep all. ``extra`` names a string column that is handed through. An empty table gives no rows.

    ``length`` is at least GRAM + 8. Anchors that more than ``hot_blocks`` blocks have, or that have more than
    ``hot_contexts`` different contexts, are looked up string by string. Beyond ``direct`` shards or blocks rows are
    packed on their way, so that they do not grow with the product of the two.
    """
    spark, gram = docs.sparkSession, GRAM
    blocks = write_blocks(docs, block_bytes, extra)
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(least_shards, -(-total // shard_bytes))
    there, back = Route.to(shards, direct), Route.to(max(1, -(-total // block_bytes)), direct)
    counted = _count_anchors(blocks, shards, length, gram, there)
    marks_path, found_path = fresh_path(spark, "marks"), fresh_path(spark, "found")
    write_table(there.grouped(counted).applyInPandas(_shared_anchors(hot_blocks, hot_contexts, back), back.schema), marks_path)
    marks = spark.read.schema(back.schema).parquet(marks_path)
    sent = blocks.groupBy("block").cogroup(back.grouped(marks)).applyInPandas(_send_contexts(shards, length, gram, there), there.schema)
    write_table(there.grouped(sent).applyInPandas(_search_shard(length, chunk, back), back.schema), found_path)
    drop_path(spark, marks_path)
    told = spark.read.schema(back.schema).parquet(found_path)
    return blocks.groupBy("block").cogroup(back.grouped(told)).applyInPandas(_apply(length, keep), RESULT)


_SQL = """
WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS data FROM documents),
strings AS (SELECT doc_id, p, array_slice(data, p + 1, p + 50) AS s FROM docs, unnest(range(0, greatest(octet_length(data) - 49, 0))) AS t(p)),
firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s),
hits AS (SELECT doc_id, p, p > coalesce(lag(p) OVER w + 50, -1) AS starts FROM strings JOIN firsts USING (s) WHERE first < doc_id WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
numbered AS (SELECT doc_id, p, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM hits),
spans AS (SELECT doc_id, span, min(p) AS lo, max(p) + 50 AS hi FROM numbered GROUP BY doc_id, span),
gaps AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS kept_from FROM spans),
cut AS (
  SELECT doc_id, CAST(sum(hi - lo) AS BIGINT) AS n_removed, count(*) AS n_spans, max(hi) AS last,
    string_agg(CASE WHEN lo > kept_from THEN hex(array_slice(data, kept_from + 1, lo)) ELSE '' END, '' ORDER BY lo) AS kept
  FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(octet_length(data) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || CASE WHEN octet_length(data) > coalesce(last, 0) THEN hex(array_slice(data, coalesce(last, 0) + 1, octet_length(data))) ELSE '' END)) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)"""


@query("op8_suffix_array_dedup", _SQL)
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep="digest").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").cast("string").alias("kept_sha256"))
