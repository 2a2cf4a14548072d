"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is its words, lower-case, each ended by a space, and a closing byte. Words are coded byte by byte and
bytes bit by bit. Five predictors look at the last one to four bytes of the word, or at all of it so far, under
a hash of that context, and know how often each next byte followed there in the training words. A gate (the
bit, the longest context that was seen, how often the word so far was) chooses the weights that mix them in
the logistic domain, and an adaptive map refines the result. What is so priced is combined, for every text on
its own and in its order, with the words the text had before, by several shares at once whose weights follow
from how well they did so far.

All different words lie in sorted shards. A shard is a tree of prefixes, so every byte under every prefix is
learned and priced once, however many texts hold it. What its contexts counted in all other shards comes by a
join, so nothing that grows with the corpus is broadcast.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.blocks import squeeze, unsqueeze, write_blocks
from holdfast.llm.common import give_back, map_rows, query, table
from holdfast.session import drop_path, fresh_path, staged, write_table

ORDERS = (1, 2, 3, 4)
WORD = len(ORDERS)  # the predictor that looks at the word so far comes after them
INPUTS = WORD + 1
CROSSING = 7  # marks contexts that are whole prefixes, known to several shards
GAP, END = b" ", b"\n"
START = 10  # stands before a word
BLOCK_BYTES = 16 << 20
SHARD_WORDS = 60_000
PORTION_TOKENS = 200_000
LEVELS = (1, 2, 3, 4, 6, 9, 14, 22, 40)  # counts are told apart so far; larger ones speak for themselves
FAN_IN = 64
FAR = 11.0  # largest stretched probability
STEPS = 33  # of the adaptive map
OFTEN = (1, 3, 10, 100)  # how often the word so far was, for the gate
GATES = (len(ORDERS) + 1) * (len(OFTEN) + 1)
BATCH = 4_096
#: How firmly the first weights are held, in passings, and the most a batch moves a weight.
PRIOR = 20.0
LARGEST_STEP = 0.05
TRUST = (0.0, 0.3, 0.5, 0.8, 1.0)
#: Shares of the words a text had before, each an expert of its own.
SHARES = (0.0, 0.02, 0.1, 0.3)

_LEVEL = np.searchsorted(LEVELS, np.arange(LEVELS[-1] + 1), side="right")


def words_of(data: bytes) -> list[bytes]:
    return data.lower().split()


def coded(token: bytes) -> bytes:
    """The bytes of a token; no token's bytes begin another's."""
    return token if token == END else token + GAP


def _fold_of(doc_id, modulus: int) -> int:
    from zlib import crc32

    return -1 if doc_id is None else crc32(str(doc_id).encode()) % modulus


# ---- a shard of words ----------------------------------------------------------------------------

def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x, y = np.frombuffer(a[:n], np.uint8), np.frombuffer(b[:n], np.uint8)
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else n


class Tree:
    """The prefixes of sorted coded words: one edge for every byte under every prefix.

    ``first`` is where an edge's byte first lies in the joined words, ``parent`` the edge before it (-1: none),
    ``count`` how often the edge was passed in training, and ``path`` the edge of every byte of every word.
    """

    def __init__(self, words: list[bytes], counts: np.ndarray):
        self.flat = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        n, total = len(words), len(self.flat)
        shared = np.zeros(n, np.int64)  # bytes each word has in common with the one before
        same = np.flatnonzero(np.minimum(sizes[1:], sizes[:-1]) > 0) + 1
        column = 0
        while len(same):
            same = same[(sizes[same] > column) & (sizes[same - 1] > column)]
            same = same[self.flat[self.starts[same] + column] == self.flat[self.starts[same - 1] + column]]
            column += 1
            shared[same] = column
        row = np.repeat(np.arange(n), sizes)
        self.depth = np.arange(total) - self.starts[row]
        new = self.depth >= shared[row]
        self.path = np.cumsum(new) - 1
        rows = np.arange(n)
        for column in range(int(shared.max(initial=0))):  # a shared byte has the edge of the last word that brought it
            rows = rows[sizes[rows] > column]
            at = self.starts[rows] + column
            brought = np.maximum.accumulate(np.where(shared[rows] <= column, np.arange(len(rows)), 0))
            self.path[at] = self.path[at[brought]]
        self.first = np.flatnonzero(new)
        self.depth = self.depth[self.first]
        before = self.path[np.maximum(self.first - 1, 0)]
        self.parent = np.where(self.depth == 0, -1, before)
        self.byte = self.flat[self.first].astype(np.int64)
        self.count = np.bincount(self.path, weights=counts[row], minlength=len(self.first)).astype(np.int64)

    def context(self, order: int) -> np.ndarray:
        """The last ``order`` bytes before each edge, and the order, as one number."""
        out = np.full(len(self.first), order << 52, np.int64)
        for back in range(1, order + 1):
            byte = np.where(self.depth >= back, self.flat[np.maximum(self.first - back, 0)], START).astype(np.int64)
            out += byte << (8 * (back - 1))
        return out

    def crossing(self, word: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``length`` + 1 prefixes of a word, as nodes (the edge before them, -1: none) and as contexts."""
        start = self.starts[word]
        nodes = np.concatenate([[-1], self.path[start:start + length]])
        hashes, value = [0], 0
        for byte in self.flat[start:start + length].tolist():
            value = (value * 0x9E3779B97F4A7C15 + byte + 1) & ((1 << 64) - 1)
            hashes.append((value ^ (value >> 29)) * 0xBF58476D1CE4E5B9 >> 12 & ((1 << 52) - 1))
        return nodes, np.array(hashes, np.int64) + (CROSSING << 52)


class Shard:
    """A tree with, for every edge, the context of each predictor."""

    def __init__(self, body: bytes, before: bytes | None, after: bytes | None):
        self.tokens, self.counts = unsqueeze(body)
        words = [coded(t) for t in self.tokens]
        self.tree = tree = Tree(words, self.counts)
        self.contexts = [tree.context(order) for order in ORDERS]
        own = tree.parent + 1
        for word, beside in ((0, before), (-1, after)):  # prefixes that words of the neighbours have too
            if beside is not None:
                nodes, names = tree.crossing(word, _common(words[word], coded(beside)))
                order = np.argsort(nodes)
                spot = np.minimum(np.searchsorted(nodes[order], tree.parent), len(nodes) - 1)
                hit = nodes[order][spot] == tree.parent
                own = np.where(hit, names[order][spot], own)
        self.contexts.append(own)

    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """Different ``(context, byte)`` of contexts that other shards may know, and their own counts."""
        keys = np.concatenate([(c << 8) | self.tree.byte for c in self.contexts[:WORD]])
        times = np.tile(self.tree.count, WORD)
        shared = self.contexts[WORD] >= 1 << 52
        keys = np.concatenate([keys, (self.contexts[WORD][shared] << 8) | self.tree.byte[shared]])
        return _added_up(keys, np.concatenate([times, self.tree.count[shared]]))

    def counted(self, keys: np.ndarray, times: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each predictor the place of every edge in its table, and the table.

        ``keys`` and ``times`` are what all shards counted under the shared contexts. Row ``d`` of a table says
        how often a byte came that has the first ``d`` bits of the edge's byte.
        """
        out = []
        for i, context in enumerate(self.contexts):
            mine = (context << 8) | self.tree.byte
            tag = (keys >> 60) == (ORDERS[i] if i < WORD else CROSSING)
            if i < WORD:
                table_keys, table_times = _added_up(np.concatenate([keys[tag], mine]), np.concatenate([times[tag], np.zeros(len(mine), np.int64)]))
            else:
                alone = context < 1 << 52
                known = np.concatenate([keys[tag], mine[alone], mine[~alone]])
                table_keys, table_times = _added_up(known, np.concatenate([times[tag], self.tree.count[alone], np.zeros(int((~alone).sum()), np.int64)]))
            rows = np.empty((9, len(table_keys)), np.int64)
            for bits in range(9):
                rows[bits] = _spread(table_keys >> (8 - bits), table_times)
            out.append((np.searchsorted(table_keys, mine).astype(np.int32), rows))
        return out


def _added_up(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(times, first) if len(keys) else times


def _spread(groups: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The sum of each run of equal groups, for every row of it."""
    if not len(groups):
        return times
    first = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    return np.repeat(np.add.reduceat(times, first), np.diff(np.append(first, len(groups))))


# ---- the mixer -----------------------------------------------------------------------------------

class Mixer:
    """What small counts mean, gated weights and the adaptive map.

    Everything is seen from the bit that came: a predictor's two counts are those of this bit and of the
    other. All tables answer the other bit with the opposite, so the two always share out all probability.
    """

    def __init__(self):
        few = np.arange(len(LEVELS) + 1) + 0.4
        self.seen = np.tile(few[:, None] / (few[:, None] + few[None, :]), (INPUTS, 1, 1))  # by counts of this bit and the other
        self.weights = np.zeros((8, len(ORDERS) + 1, len(OFTEN) + 1, INPUTS))  # at first the word so far, the more the oftener it was, and
        self.weights[..., WORD] = TRUST  # the longest context that was seen
        for longest in range(1, len(ORDERS) + 1):
            self.weights[:, longest, :, longest - 1] = 1 - np.array(TRUST)
        self.weights = self.weights.reshape(8, GATES, INPUTS)
        self.sure = np.tile(PRIOR * np.eye(INPUTS), (8, GATES, 1, 1))  # how firmly each gate holds its weights
        self.map = np.zeros((8 * (len(ORDERS) + 1), STEPS))

    def inputs(self, counted, edges, bit: int, own: int):
        """Stretched probabilities of the bit that came, levels of both counts, gate and map number; ``own`` is taken off first."""
        x = np.empty((len(edges), INPUTS))
        levels = []
        longest = np.zeros(len(edges), np.int64)
        for i, (place, rows) in enumerate(counted):
            at = place[edges]
            every, this = rows[bit][at] - own, rows[bit + 1][at] - own
            other = every - this
            a, b = _LEVEL[np.minimum(this, LEVELS[-1])], _LEVEL[np.minimum(other, LEVELS[-1])]
            small = np.log(self.seen[i][a, b] / self.seen[i][b, a])
            many = np.maximum(this, other) >= LEVELS[-1]
            x[:, i] = np.where(many, np.log((this + 0.4) / (other + 0.4)), small)
            levels.append((a, b))
            if i < WORD:
                longest = np.where(every >= 3, i + 1, longest)
            else:
                gate = longest * (len(OFTEN) + 1) + np.searchsorted(OFTEN, every, side="right")
        return np.clip(x, -FAR, FAR), levels, gate, bit * (len(ORDERS) + 1) + longest

    def mixed(self, x, bit: int, gate):
        return np.clip(np.einsum("ij,ij->i", self.weights[bit][gate], x), -12, 12)

    def refined(self, dot, number):
        """The probability after the adaptive map, which is read between its two nearest steps."""
        centre = 1 / (1 + np.exp(8 - 16 * np.arange(STEPS) / (STEPS - 1)))
        mapped = (self.map + 8 * centre) / (self.map + self.map[:, ::-1] + 8)
        step = (np.clip(dot, -8, 8) + 8) * ((STEPS - 1) / 16)
        low = np.minimum(step.astype(np.int64), STEPS - 2)
        part = step - low
        here = mapped[number, low] * (1 - part) + mapped[number, low + 1] * part
        return np.clip(0.5 * (1 / (1 + np.exp(-dot)) + here), 1e-7, 1 - 1e-7)

    def learn(self, counted, count: np.ndarray, seed: int) -> None:
        """Online over all edges of a shard in a random order: each batch is predicted with what was learned before it.

        An edge stands for all its passings in training, each predicted by the others. The weights of a gate move
        by Newton steps: the further, the less it has seen that would speak against it.
        """
        order = np.random.default_rng(seed).permutation(np.flatnonzero(count > 0))
        for lo in range(0, len(order), BATCH):
            edges = order[lo:lo + BATCH]
            times = count[edges].astype(np.float64)
            for bit in range(8):
                x, levels, gate, number = self.inputs(counted, edges, bit, own=1)
                dot = self.mixed(x, bit, gate)
                p = 1 / (1 + np.exp(-dot))
                for i, (a, b) in enumerate(levels):
                    np.add.at(self.seen[i], (a, b), times)
                step = np.rint((np.clip(dot, -8, 8) + 8) * ((STEPS - 1) / 16)).astype(np.int64)
                np.add.at(self.map, (number, step), times)
                by = np.argsort(gate, kind="stable")
                ends = np.searchsorted(gate[by], np.arange(GATES + 1))
                for g in np.flatnonzero(np.diff(ends)):
                    mine = by[ends[g]:ends[g + 1]]
                    seen = x[mine] * times[mine, None]
                    self.sure[bit, g] += (seen * (p * (1 - p))[mine, None]).T @ x[mine]
                    step = np.linalg.solve(self.sure[bit, g], (1 - p[mine]) @ seen)
                    self.weights[bit, g] += step * min(1, LARGEST_STEP / max(np.abs(step).max(), 1e-12))

    def log_prices(self, counted, n: int, at_once: int = 100_000) -> np.ndarray:
        """The natural log probability of every edge's byte after its prefix."""
        out = np.zeros(n)
        for lo in range(0, n, at_once):
            edges = np.arange(lo, min(lo + at_once, n))
            for bit in range(8):
                x, _, gate, number = self.inputs(counted, edges, bit, own=0)
                out[edges] += np.log(self.refined(self.mixed(x, bit, gate), number))
        return out

    def numbers(self) -> np.ndarray:
        """What is learned as one row of numbers that can be added up; weights count by how firmly they are held."""
        fresh = Mixer()
        firm = self.sure - fresh.sure
        return np.concatenate([(self.seen - fresh.seen).ravel(), self.map.ravel(), firm.ravel(), np.einsum("bgij,bgj->bgi", firm, self.weights).ravel()])

    @staticmethod
    def of_numbers(numbers: np.ndarray) -> Mixer:
        made = Mixer()
        if len(numbers):
            seen, mapped, firm, held = np.split(numbers, np.cumsum([made.seen.size, made.map.size, made.sure.size]))
            made.seen += seen.reshape(made.seen.shape)
            made.map += mapped.reshape(made.map.shape)
            prior = np.einsum("bgij,bgj->bgi", made.sure, made.weights)
            made.sure += firm.reshape(made.sure.shape)
            made.weights = np.linalg.solve(made.sure, (prior + held.reshape(made.weights.shape))[..., None])[..., 0]
        return made


# ---- words of the corpus, in shards -----------------------------------------------------------------

def _numbered(texts: list[bytes], number: dict[bytes, int]):
    """For each text the numbers of its words and, last, of its end; tokens not met before are given the next number."""
    for text in texts:
        yield [number.setdefault(token, len(number)) for token in (*words_of(text), END)]


def _block_tokens(blocks: DataFrame, modulus: int, held: int) -> DataFrame:
    """``(block, i, token, n)``: the different tokens of each block by their number in it, and how often its training documents have them."""

    def run(batches):
        for batch in batches:
            for block, body in zip(batch.column("block").to_pylist(), batch.column("body").to_pylist(), strict=True):
                ids, texts, _ = unsqueeze(body)
                number: dict[bytes, int] = {}
                times = np.zeros(0, np.int64)
                for doc_id, found in zip(ids, _numbered(texts, number), strict=True):
                    if len(number) > len(times):
                        times = np.concatenate([times, np.zeros(len(number), np.int64)])
                    if _fold_of(doc_id, modulus) != held:
                        np.add.at(times, found, 1)
                tokens = list(number)
                for lo in range(0, len(tokens), 20_000):
                    some = tokens[lo:lo + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block] * len(some), pa.int64()), pa.array(np.arange(lo, lo + len(some), dtype=np.int32)), pa.array(some, pa.binary()),
                         pa.array(times[lo:lo + len(some)])], names=["block", "i", "token", "n"])

    return blocks.select("block", "body").mapInArrow(run, "block bigint, i int, token binary, n bigint")


def _word_shards(tokens: DataFrame, shard_words: int) -> DataFrame:
    """``(part, body, before, after)``: sorted tokens with their counts, and the tokens next to the shard's two ends."""
    spark = tokens.sparkSession

    def run(batches):
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        held: tuple[list, list] = ([], [])

        def packed():
            return pa.RecordBatch.from_pylist([{
                "part": (task << 32) + made, "first": held[0][0], "last": held[0][-1],
                "body": squeeze((held[0], np.array(held[1], np.int64)))}], schema)

        schema = pa.schema([("part", pa.int64()), ("first", pa.binary()), ("last", pa.binary()), ("body", pa.binary())])
        for batch in batches:
            for token, c in zip(batch.column("token").to_pylist(), batch.column("c").to_pylist(), strict=True):
                held[0].append(token)
                held[1].append(c)
                if len(held[0]) >= 2 * shard_words:
                    yield packed()
                    held, made = ([], []), made + 1
        if held[0]:
            yield packed()

    ranges = max(1, -(-tokens.count() // shard_words))
    # coded tokens are in the order of the tokens with their ending; a space comes before all bytes of words but control bytes
    ordered = tokens.withColumn("_coded", F.when(F.col("token") == F.lit(END), F.col("token")).otherwise(F.concat("token", F.lit(GAP))))
    placed = ordered.repartitionByRange(ranges, "_coded").sortWithinPartitions("_coded").select("token", "c")
    shards = staged(placed.mapInArrow(run, "part bigint, first binary, last binary, body binary"), "word-shards")
    along = Window.orderBy("part")  # one short row a shard
    ends = shards.select("part", F.lag("last").over(along).alias("before"), F.lead("first").over(along).alias("after"))
    return shards.select("part", "body").join(ends, "part")


def _contexts_asked(shards: DataFrame) -> DataFrame:
    """``(part, context, byte, n)``: what each shard counted under contexts that others may know; 0 if it only asks."""

    def run(batches):
        for batch in batches:
            for part, body, before, after in zip(*(batch.column(c).to_pylist() for c in ("part", "body", "before", "after")), strict=True):
                keys, times = Shard(body, before, after).asked()
                for lo in range(0, len(keys), 100_000):
                    some = keys[lo:lo + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), part)), pa.array(some >> 8), pa.array((some & 255).astype(np.int32)), pa.array(times[lo:lo + 100_000])],
                        names=["part", "context", "byte", "n"])

    return shards.mapInArrow(run, "part bigint, context bigint, byte int, n bigint")


def _with_counts(shards: DataFrame, told: DataFrame, each, ddl: str) -> DataFrame:
    """``each(part, shard, counted)`` for every shard, with what all shards counted under its contexts."""

    def run(mine, rows):
        if not len(mine):
            return each(None, None, None)
        one = mine.iloc[0]
        shard = Shard(bytes(one.body), one.before, one.after)
        keys = (rows.context.to_numpy(np.int64) << 8) | rows.byte.to_numpy(np.int64)
        made = each(int(one.part), shard, shard.counted(*_added_up(keys, rows.n.to_numpy(np.int64))))
        give_back()
        return made

    return shards.groupBy("part").cogroup(told.groupBy("part")).applyInPandas(run, ddl)


def _added_mixers(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(body) for body in rows.body)
    return pd.DataFrame({"place": [int(rows.place.iloc[0])], "body": [total.tobytes()]})


def _learned(shards: DataFrame, told: DataFrame) -> Mixer:
    """One mixer from all shards: each learns online from its own words; sums are added up, weights averaged by how firm they are.

    A shard gives one row of fixed size. Rows are added up in a tree, ``FAN_IN`` at a time.
    """

    def each(part, shard, counted):
        mixer = Mixer()
        if shard is not None:
            mixer.learn(counted, shard.tree.count, seed=part)
        return pd.DataFrame({"place": [part or 0], "body": [mixer.numbers().tobytes()]})

    schema = "place bigint, body binary"
    state = staged(_with_counts(shards, told, each, schema), "mixers")
    places = state.count()
    while places > 1:
        places = -(-places // FAN_IN)
        dealt = state.withColumn("place", F.pmod(F.xxhash64("place"), F.lit(places)))
        state = staged(dealt.groupBy("place").applyInPandas(_added_mixers, schema), "mixers")
    made = state.first()
    return Mixer.of_numbers(np.frombuffer(made.body) if made else np.empty(0))


def _priced(shards: DataFrame, told: DataFrame, sent) -> DataFrame:
    """``(token, c, price)``: the natural log probability of every token as a whole."""

    def each(part, shard, counted):
        if shard is None:
            return pd.DataFrame({"token": [], "c": [], "price": []})
        tree = shard.tree
        edges = sent.value.log_prices(counted, len(tree.first))
        return pd.DataFrame({"token": shard.tokens, "c": shard.counts, "price": np.add.reduceat(edges[tree.path], tree.starts)})

    return _with_counts(shards, told, each, "token binary, c bigint, price double")


# ---- texts ---------------------------------------------------------------------------------------

def earlier_in_text(text_of: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """How often each token came before in its text; texts lie one after the other."""
    order = np.lexsort((tokens, text_of))
    text_of, tokens = text_of[order], tokens[order]
    n = len(order)
    first = np.append(True, (tokens[1:] != tokens[:-1]) | (text_of[1:] != text_of[:-1]))[:n]
    out = np.empty(n, np.int64)
    out[order] = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    return out


def text_scores(prices: np.ndarray, end_price: float, tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural log probabilities of texts of ``sizes`` words each, given one after the other as numbers of ``prices``.

    For each share, a word has that share of its probability from the words of the text before it, in
    proportion, and the rest from its price. Whole texts are mixed over the shares, which is the same as
    mixing every word with weights that follow from the words before.
    """
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    before = earlier_in_text(text_of, tokens)
    price = prices[tokens]
    later, again = place > 0, np.flatnonzero(before > 0)
    totals = np.empty((len(SHARES), len(sizes)))
    for i, share in enumerate(SHARES):
        mine = price + math.log1p(-share) * later
        if share:
            mine[again] = np.logaddexp(mine[again], np.log(share * before[again] / place[again]))
        totals[i] = np.bincount(text_of, weights=mine, minlength=len(sizes)) + end_price + math.log1p(-share) * (sizes > 0)
    top = totals.max(axis=0)
    return top + np.log(np.exp(totals - top).mean(axis=0))


SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, n_bytes bigint, "
          "bits_per_byte double")


def _score_block(modulus: int, held: int, tokens: int, kinds: int):
    below = math.log10(tokens + kinds + 1)  # one is added to each kind of token, and to one not seen

    def run(blocks, vocabulary):
        out = []
        if len(blocks):
            ids, texts, _ = unsqueeze(blocks.body.iloc[0])
            counts, prices = np.empty(len(vocabulary), np.int64), np.empty(len(vocabulary))
            counts[vocabulary.i], prices[vocabulary.i] = vocabulary.c, vocabulary.price
            logs = np.log10(counts + 1.0)
            number: dict[bytes, int] = {}
            rows = _numbered(texts, number)
            lo = 0
            while lo < len(ids):
                some, sizes, many = [], [], 0
                while lo + len(sizes) < len(ids) and many < PORTION_TOKENS:
                    found = next(rows)
                    some.append(np.array(found[:-1], np.int32))
                    sizes.append(len(found) - 1)
                    many += len(found)
                hi, end = lo + len(sizes), number[END]
                some, sizes = np.concatenate(some), np.array(sizes, np.int64)
                text_of = np.repeat(np.arange(len(sizes)), sizes)
                add = lambda values, own: np.bincount(text_of, weights=values[some], minlength=len(sizes)) + own
                lengths = np.fromiter(map(len, number), np.int64, len(number))
                n_bytes = add(lengths + 1, 1).astype(np.int64)
                scores = text_scores(prices, prices[end], some, sizes) / math.log(10)
                out.append(pd.DataFrame({
                    "doc_id": pd.array(ids[lo:hi], "Int64"), "held_out": [_fold_of(i, modulus) == held for i in ids[lo:hi]], "n_tokens": sizes + 1,
                    "n_known": add(counts > 0, int(counts[end] > 0)).astype(np.int64), "base_score": add(logs, logs[end]) - (sizes + 1) * below,
                    "score": scores, "n_bytes": n_bytes, "bits_per_byte": -scores / math.log10(2) / n_bytes}))
                lo = hi
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in SCORES.split(", ")})

    return run


def score_texts(docs: DataFrame, modulus: int, held: int, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Base and model scores of every row of ``docs``; rows of the fold ``held`` teach nothing.

    Columns are ``doc_id, held_out, n_tokens, n_known, base_score, score, n_bytes, bits_per_byte`` and
    ``train_tokens``. Null and empty texts are an end alone. Rows without a doc_id are training rows. Repeated
    rows count and score each. An empty table gives no rows. Texts are never joined row by row: blocks of
    documents meet the counts and prices of their own different words.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = write_blocks(docs, block_bytes)
    seen = staged(_block_tokens(blocks, modulus, held), "block-tokens")
    tokens = staged(seen.groupBy("token").agg(F.sum("n").alias("c")), "tokens")
    sums = tokens.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count_if(F.col("c") > 0).alias("kinds")).first()
    shards = staged(_word_shards(tokens, shard_words), "shards")
    asked_path, told_path = fresh_path(spark, "asked"), fresh_path(spark, "told")
    asked = _contexts_asked(shards)
    write_table(asked, asked_path)
    asked = spark.read.schema(asked.schema).parquet(asked_path)
    counted = asked.where("n > 0").groupBy("context", "byte").agg(F.sum("n").alias("n"))
    told = asked.select("part", "context").distinct().join(counted, "context").select("part", "context", "byte", "n")
    write_table(told, told_path)
    told = spark.read.schema(told.schema).parquet(told_path)
    drop_path(spark, asked_path)
    sent = spark.sparkContext.broadcast(_learned(shards, told))
    priced = staged(_priced(shards, told, sent), "prices")
    drop_path(spark, told_path)
    vocabulary = seen.select("block", "i", "token").join(priced, "token").select("block", "i", "c", "price")
    scored = blocks.groupBy("block").cogroup(vocabulary.groupBy("block")).applyInPandas(_score_block(modulus, held, sums.tokens, sums.kinds), SCORES)
    return scored.withColumn("train_tokens", F.lit(sums.tokens).cast("long"))


@query("op7_context_mixing_lm")
def op7_context_mixing_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), 7, 2)
