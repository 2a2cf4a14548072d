"""Language identification: averaged hashed subword embeddings under a linear softmax.

Subwords are byte n-grams inside words, word ends included. Each has a bucket with a small vector; a text is
the mean of its vectors, and a linear softmax over that names the language. Both are trained by stochastic
gradient descent in numpy. A temperature and a rejection level are then set on rows that were kept aside.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import fold, map_rows, query, table, utf8
from holdfast.llm.fitting import fit_in_task, unit_hash
from holdfast.session import staged

BUCKETS = 1 << 15
WIDTH = 16
ROWS_PER_LANGUAGE = 1_500
#: All rows a model is fitted on, and the most values of lang whose shares are broadcast.
MOST_ROWS = 60_000
MOST_LANGUAGES = 10_000
KEPT_RIGHT = 0.995
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")

_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def subwords(text: str):
    """Buckets of the 1- to 4-grams of ``text``, in order, repeats included, in arrays of bounded size."""
    import numpy as np

    words = utf8(text.lower()).translate(_LETTERS).split()
    if not words:
        return
    line = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8)
    for lo in range(0, len(line), 1 << 20):
        part = line[lo: lo + (1 << 20) + 3].astype(np.uint32)
        space = part == 32
        grams = part * np.uint32(0x9E3779B1)
        yield _bucket(grams[: 1 << 20][~space[: 1 << 20]])
        inside = np.ones(len(part), dtype=bool)
        for n in range(2, 5):
            if len(part) < n:
                break
            grams = (grams[:-1] ^ (grams[:-1] >> 13)) * np.uint32(0x85EBCA77) + part[n - 1:] * np.uint32(0xC2B2AE3D)
            if n > 2:
                inside = inside[:-1] & ~space[n - 2: len(part) - 1]
            else:
                inside = inside[:-1]
            yield _bucket(grams[: 1 << 20][inside[: 1 << 20]])


def _bucket(grams):
    import numpy as np

    return ((grams ^ (grams >> 15)) * np.uint32(0x27D4EB2F)) >> np.uint32(17)


def counted(text: str):
    """Buckets of ``text`` and how often each occurs."""
    import numpy as np

    counts = np.zeros(BUCKETS, dtype=np.int64)
    for buckets in subwords(text):
        counts += np.bincount(buckets, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def fit_softmax(rows: list[tuple], epochs: int = 6, rate: float = 4.0, seed: int = 3) -> dict:
    """The model from ``(doc_id, lang, buckets, counts)`` rows; one row in five only calibrates."""
    import numpy as np

    names = sorted({lang for _, lang, _, _ in rows})
    place = {n: i for i, n in enumerate(names)}
    data = [(place[lang], np.frombuffer(b, dtype=np.uint16).astype(np.int64), np.frombuffer(c, dtype=np.int64)) for _, lang, b, c in rows]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(data))
    aside, kept = order[: len(data) // 5], order[len(data) // 5:]
    vectors = rng.uniform(-0.5, 0.5, (BUCKETS, WIDTH))
    output, bias = np.zeros((WIDTH, len(names))), np.zeros(len(names))
    steps, done = max(1, epochs * len(kept)), 0
    for _ in range(epochs):
        for i in rng.permutation(kept):
            label, buckets, counts = data[i]
            if not len(buckets):
                continue
            now = rate * (1 - done / steps)
            done += 1
            share = counts / counts.sum()
            mean = share @ vectors[buckets]
            wrong = _softmax(mean @ output + bias)
            wrong[label] -= 1
            back = output @ wrong
            output -= now * 0.1 * np.outer(mean, wrong)
            bias -= now * 0.01 * wrong
            vectors[buckets] -= now * share[:, None] * back
    table_ = (vectors @ output).astype(np.float32)
    logits, right = [], []
    for i in aside:
        label, buckets, counts = data[i]
        if len(buckets):
            logits.append((counts / counts.sum()) @ table_[buckets] + bias)
            right.append(label)
    heat, level = _calibrated(np.array(logits).reshape(-1, len(names)), np.array(right, dtype=int))
    return {"names": names, "table": table_, "bias": bias, "heat": heat, "level": level}


def _softmax(x):
    import numpy as np

    e = np.exp(x - x.max())
    return e / e.sum()


def _calibrated(logits, right) -> tuple[float, float]:
    """The temperature of least log loss, and the lowest score above which KEPT_RIGHT of the rows are right."""
    import numpy as np

    if not len(right):
        return 1.0, 0.0

    def spread(heat):
        e = np.exp((logits - logits.max(axis=1, keepdims=True)) / heat)
        return e / e.sum(axis=1, keepdims=True)

    heats = np.geomspace(0.05, 20, 60)
    loss = [-np.log(spread(h)[np.arange(len(right)), right] + 1e-12).mean() for h in heats]
    heat = float(heats[int(np.argmin(loss))])
    p = spread(heat)
    top, good = p.max(axis=1), p.argmax(axis=1) == right
    order = np.argsort(-top, kind="stable")
    rates = np.cumsum(good[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero(rates >= KEPT_RIGHT)
    return heat, float(top[order][enough[-1]]) if len(enough) else 1.0


def train(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, most_rows: int = MOST_ROWS, most_languages: int = MOST_LANGUAGES) -> dict | None:
    """A model from about ``rows_per_language`` rows of each value of ``lang``, chosen by a hash of doc_id and text.

    All values of ``lang`` together have about ``most_rows`` rows at most, however many they are. Rows with a null
    language or no letters are left out. Texts stay where they are: the shares of up to ``most_languages`` values
    are sent to them; beyond that Spark chooses how to join. None if nothing can be learned.
    """
    usable = docs.select(F.col("doc_id").cast("long"), "text", "lang").where("lang is not null and text is not null")
    named = staged(usable.groupBy("lang").count(), "languages")
    languages = named.count()
    wanted = min(rows_per_language, most_rows / max(languages, 1))
    shares = named.select("lang", (F.lit(float(wanted)) / F.col("count")).alias("share"))
    shares = F.broadcast(shares) if languages <= most_languages else shares
    chosen = usable.join(shares, "lang").where(unit_hash(11, "doc_id", "text") < F.col("share"))

    def run(rows):
        import numpy as np

        for doc_id, lang, text in rows:
            if LETTER.search(text):
                buckets, counts = counted(text)
                yield doc_id, lang, buckets.astype(np.uint16).tobytes(), counts.tobytes()

    features = map_rows(chosen.select("doc_id", "lang", "text"), "doc_id bigint, lang string, buckets binary, counts binary", run)
    model = fit_in_task(features, lambda rows: fit_softmax(rows) if rows else None)
    return model


def identify(docs: DataFrame, model: dict | None) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` for every row, from its whole text alone; no shuffle.

    Null texts and texts without a letter, and every text if there is no model, are ``und`` with score 0 and
    rejected. Otherwise the likeliest language is named with its calibrated probability, and ``rejected`` says
    that this is below the level at which the model was right often enough.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows):
        import numpy as np

        known = sent.value
        for doc_id, text in rows:
            if known is None or text is None or not LETTER.search(text):
                yield doc_id, UNKNOWN, 0.0, True
                continue
            total, seen = np.zeros(len(known["names"])), 0
            for buckets in subwords(text):
                total += known["table"][buckets].sum(axis=0, dtype=np.float64)
                seen += len(buckets)
            p = _softmax((total / max(1, seen) + known["bias"]) / known["heat"])
            best = int(p.argmax())
            yield doc_id, known["names"][best], float(p[best]), bool(p[best] < known["level"])

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id bigint, lang_pred string, score double, rejected boolean", run)


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    found = identify(docs, train(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
