"""Context mixing: word trees, prices against a coder that goes bit by bit, and scores against plain sums."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import common, mixing

SF = "/root/testdata/sf0.01"


class SlowCoder:
    """Probabilities of one byte after another from dictionaries of counts, a bit at a time."""

    def __init__(self, counts, mixer):
        self.mixer, self.counts = mixer, {}
        for token, n in counts.items():
            word = mixing.coded(token)
            for at, byte in enumerate(word):
                for context in self.contexts(word[:at]):
                    self.counts.setdefault(context, Counter())[byte] += n

    @staticmethod
    def contexts(prefix):
        padded = bytes([mixing.START]) * 4 + prefix
        return [(k, padded[-k:]) for k in mixing.ORDERS] + [("word", prefix)]

    def probability(self, prefix, byte):
        p = 1.0
        for bit in range(8):
            x, longest = [], 0
            for i, context in enumerate(self.contexts(prefix)):
                followed = self.counts.get(context, {})
                every = sum(n for b, n in followed.items() if b >> (8 - bit) == byte >> (8 - bit))
                this = sum(n for b, n in followed.items() if b >> (7 - bit) == byte >> (7 - bit))
                other = every - this
                if max(this, other) >= mixing.LEVELS[-1]:
                    stretched = math.log((this + 0.4) / (other + 0.4))
                else:
                    a, b = (sum(level <= n for level in mixing.LEVELS) for n in (this, other))
                    stretched = math.log(self.mixer.seen[i][a][b] / self.mixer.seen[i][b][a])
                x.append(max(-mixing.FAR, min(mixing.FAR, stretched)))
                if i < mixing.WORD:
                    longest = i + 1 if every >= 3 else longest
            gate = longest * (len(mixing.OFTEN) + 1) + sum(level <= every for level in mixing.OFTEN)
            dot = max(-12, min(12, sum(w * v for w, v in zip(self.mixer.weights[bit][gate], x, strict=True))))
            row = self.mixer.map[bit * (len(mixing.ORDERS) + 1) + longest]
            place = (max(-8, min(8, dot)) + 8) * (mixing.STEPS - 1) / 16
            low = min(int(place), mixing.STEPS - 2)

            def mapped(k):
                centre = 1 / (1 + math.exp(8 - 16 * k / (mixing.STEPS - 1)))
                return (row[k] + 8 * centre) / (row[k] + row[mixing.STEPS - 1 - k] + 8)

            refined = mapped(low) * (1 - place + low) + mapped(low + 1) * (place - low)
            p *= max(1e-7, min(1 - 1e-7, 0.5 * (1 / (1 + math.exp(-dot)) + refined)))
        return p

    def price(self, token):
        word = mixing.coded(token)
        return sum(math.log(self.probability(word[:at], byte)) for at, byte in enumerate(word))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    parts = [b"an", b"be", b"c", b"\xc3\xa9", b"the", b"x\x01", b"q"]
    counts = Counter()
    for _ in range(900):
        counts[b"".join(rng.choices(parts, weights=range(7, 0, -1), k=rng.randrange(1, 5)))] += rng.choice([0, 1, 1, 2, 60])
    counts[mixing.END] = 300
    counts[b"be" * 2_000] = 2
    counts[b"be" * 2_000 + b"c"] = 0
    return counts


def shards_of(spark, counts, shard_words):
    tokens = spark.createDataFrame([(bytearray(t), n) for t, n in counts.items()], "token binary, c bigint").repartition(3)
    shards = mixing._word_shards(tokens, shard_words)
    asked = mixing._contexts_asked(shards).cache()
    counted = asked.where("n > 0").groupBy("context", "byte").agg(F.sum("n").alias("n"))
    return shards, asked.select("part", "context").distinct().join(counted, "context").select("part", "context", "byte", "n").cache()


def test_prices_by_a_slow_coder(spark, corpus):
    """However the words are dealt to shards, a price is what a coder finds that knows all counts."""
    shards, told = shards_of(spark, corpus, 40)
    assert shards.count() > 5
    mixer = mixing._learned(shards, told)
    assert mixer.map.sum() > 0 and not np.allclose(mixer.weights, mixing.Mixer().weights)
    slow = SlowCoder(corpus, mixer)
    picked = [t for i, t in enumerate(sorted(corpus)) if i % 9 == 0 and len(t) < 50] + [mixing.END]
    for shard_words in (40, 10_000):
        shards, told = shards_of(spark, corpus, shard_words)
        sent = spark.sparkContext.broadcast(mixer)
        prices = {bytes(r.token): (r.c, r.price) for r in mixing._priced(shards, told, sent).collect()}
        assert {t: c for t, (c, _) in prices.items()} == corpus
        for token in picked:
            assert prices[token][1] == pytest.approx(slow.price(token), abs=1e-6)


def test_bytes_share_out_all_probability(spark, corpus):
    shards, told = shards_of(spark, corpus, 500)
    slow = SlowCoder(corpus, mixing._learned(shards, told))
    for prefix in (b"", b"an", b"the\xc3", b"never seen"):
        assert sum(slow.probability(prefix, byte) for byte in range(256)) == pytest.approx(1, abs=1e-9)


def test_trees_hold_every_prefix_once():
    words = sorted(mixing.coded(w) for w in [b"a", b"ab", b"abc", b"abd", b"b", b"ba", b"\x01", b"abcdefgh" * 40, b"abcdefgh" * 40 + b"x"])
    tree = mixing.Tree(words, np.arange(1, len(words) + 1))
    prefixes = {w[:i] for w in words for i in range(1, len(w) + 1)}
    assert len(tree.first) == len(prefixes)
    at = 0
    for word in words:
        for i in range(len(word)):
            edge = tree.path[at + i]
            assert tree.depth[edge] == i and tree.byte[edge] == word[i]
            assert tree.parent[edge] == (tree.path[at + i - 1] if i else -1)
            assert tree.count[edge] == sum(k + 1 for k, w in enumerate(words) if w[:i + 1] == word[:i + 1])
        at += len(word)


def test_shares_of_earlier_words_by_brute_force():
    rng = np.random.default_rng(2)
    prices, sizes = np.log(rng.dirichlet(np.ones(9))), np.array([0, 1, 7, 40, 0, 3])
    tokens = rng.integers(0, 8, int(sizes.sum()))
    got = mixing.text_scores(prices, float(prices[8]), tokens, sizes)
    at = 0
    for size, score in zip(sizes, got, strict=True):
        mine, weights, total = tokens[at:at + size], np.ones(len(mixing.SHARES)), 0.0
        at += size
        for place, token in enumerate([*mine, 8]):  # one word after the other, with weights that follow
            seen = 0 if token == 8 or not place else (mine[:place] == token).mean()
            p = np.array([math.exp(prices[token]) * (1 - s * (place > 0)) + s * seen for s in mixing.SHARES])
            total += math.log((weights * p).sum() / weights.sum())
            weights *= p
        assert score == pytest.approx(total, abs=1e-9)


def test_base_scores_by_brute_force(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    tokens = [(i, [*(t or "").encode().lower().split(), b"\n"]) for i, t in rows]
    counts = Counter(w for i, t in tokens if mixing._fold_of(i, 7) != 2 for w in t)
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), len(t), sum(counts[w] > 0 for w in t), round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t), 6)) for i, t in tokens)
    for shard_words, block_bytes in ((mixing.SHARD_WORDS, mixing.BLOCK_BYTES), (3, 100)):
        got = mixing.score_texts(odd_docs, 7, 2, shard_words, block_bytes).collect()
        assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
        assert {r.train_tokens for r in got} == {n} and all(r.score < 0 for r in got)


def test_no_rows(spark, no_docs):
    assert mixing.score_texts(no_docs, 7, 2).count() == 0


def test_nothing_to_learn_from(spark, odd_docs):
    rows = mixing.score_texts(odd_docs.where("doc_id is not null"), 1, 0).collect()  # every row is held out
    assert {r.train_tokens for r in rows} == {0} and all(math.isfinite(r.score) and r.n_known == 0 for r in rows)


def test_held_out_texts_score_above_the_base(spark):
    """On ten thousand documents; a thousand are too few words for that."""
    rows = mixing.score_texts(common.table(spark, "/root/testdata/sf0.1", "documents"), 7, 2).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]
