"""Quality classifier: naive Bayes support vectors.

N-gram indicators are scaled by the log of how much likelier they are in one class than in the other, and a
linear hinge-loss model over them is fitted by dual coordinate descent. Its margins are turned into
probabilities on rows it was not fitted on.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import fold, map_rows, query, table, utf8
from holdfast.llm.fitting import fit_in_task, unit_hash

BUCKETS = 1 << 16
SAMPLE_ROWS = 6_000
THRESHOLD = 0.3
SHAPES = 64  # the last buckets: n-grams of equal words, and the share of capitals and of marks


def _binned(share: float) -> int:
    return 0 if share <= 0 else min(7, 1 + int(math.log2(1 + 127 * share)))


def indicators(data: bytes):
    """Buckets of the byte 3- and 4-grams of ``data``, and of its word pairs and letter shapes, each once."""
    import numpy as np

    seen = np.zeros(BUCKETS, dtype=bool)
    if not data:
        return np.flatnonzero(seen).astype(np.uint16)
    text = np.frombuffer(data, dtype=np.uint8)
    digits = (text >= 48) & (text <= 57)
    plain = np.where(digits, np.uint8(48), text)
    room = (BUCKETS - SHAPES) // 2
    for lo in range(0, len(plain), 1 << 20):  # bounded memory for texts of any length
        part = plain[lo: lo + (1 << 20) + 3].astype(np.uint32)
        if len(part) >= 3:
            three = part[:-2] * np.uint32(0x9E3779B1) + part[1:-1] * np.uint32(0x85EBCA77) + part[2:] * np.uint32(0xC2B2AE3D)
            seen[((three ^ (three >> 15)) * np.uint32(0x27D4EB2F) >> 8) % room] = True
            if len(part) >= 4:
                four = (three[:-1] ^ (three[:-1] >> 13)) + part[3:] * np.uint32(0x165667B1)
                seen[room + ((four ^ (four >> 15)) * np.uint32(0x2C1B3C6D) >> 8) % room] = True
    words = data.split()
    equal = sum(a == b for a, b in zip(words, words[1:]))
    capitals = int(((text >= 65) & (text <= 90)).sum())
    marks = int(((text > 32) & (text < 127) & ~digits & ~(((text | 32) >= 97) & ((text | 32) <= 122))).sum())
    tail = BUCKETS - SHAPES
    seen[tail + _binned(equal / max(1, len(words) - 1))] = True
    seen[tail + 8 + _binned(capitals / len(data))] = True
    seen[tail + 16 + _binned(marks / len(data))] = True
    seen[tail + 24 + _binned(int(digits.sum()) / len(data))] = True
    seen[tail + 32 + min(7, int(math.log10(1 + len(words))))] = True
    return np.flatnonzero(seen).astype(np.uint16)


def fit_nbsvm(rows: list[tuple], smoothing: float = 1.0, cost: float = 1.0, sweeps: int = 20, blend: float = 0.5, seed: int = 5):
    """``(weights, bias, slope, offset)`` from ``(doc_id, label, buckets)`` rows; one in four only calibrates."""
    import numpy as np

    rows = [(label, np.frombuffer(buckets, dtype=np.uint16)) for _, label, buckets in rows]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    kept = [rows[i] for i in order[len(rows) // 4:]] or rows
    aside = [rows[i] for i in order[: len(rows) // 4]]
    counts = np.full((2, BUCKETS), smoothing)
    for label, buckets in kept:
        counts[label, buckets] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    lengths = [math.sqrt(float((ratio[b] ** 2).sum()) + 1.0) for _, b in kept]
    weights, bias = np.zeros(BUCKETS), 0.0
    duals = np.zeros(len(kept))
    for _ in range(sweeps):
        moved = 0.0
        for i in rng.permutation(len(kept)):
            label, buckets = kept[i]
            sign = 1.0 if label else -1.0
            x = ratio[buckets] / lengths[i]
            one = 1.0 / lengths[i]
            slope = 1.0 - sign * (float(weights[buckets] @ x) + bias * one)
            new = min(max(duals[i] + slope, 0.0), cost)  # the rows have length one
            step = new - duals[i]
            if step:
                duals[i] = new
                weights[buckets] += step * sign * x
                bias += step * sign * one
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    level = np.abs(weights).mean()
    weights = (1 - blend) * level * np.sign(weights) + blend * weights if blend < 1 else weights
    scaled = weights * ratio
    margins = np.array([_margin(scaled, bias, ratio, b) for _, b in aside])
    slope, offset = calibrate(margins, np.array([label for label, _ in aside], dtype=float))
    return scaled, bias, ratio, slope, offset


def _margin(scaled, bias, ratio, buckets) -> float:
    length = math.sqrt(float((ratio[buckets] ** 2).sum()) + 1.0)
    return (float(scaled[buckets].sum()) + bias) / length


def calibrate(margins, labels) -> tuple[float, float]:
    """Slope and offset of the logistic curve through ``(margin, label)``, a little shrunk, by Newton steps."""
    import numpy as np

    positive = labels.sum()
    targets = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (len(labels) - positive + 2))
    beta = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones_like(margins)], axis=1) if len(margins) else np.zeros((0, 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - targets) + 1e-3 * beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        beta = beta - step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 1e-6)), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS):
    """A model from at most about ``sample_rows`` labelled rows, chosen by a hash of their doc_id.

    Labels other than 0 and 1 and missing ones are left out; so are texts that are null. A doc_id that is
    labelled more than once counts with its largest label. With no labelled rows every score is one half.
    """
    known = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("quality").cast("int").alias("label"))
    total = known.count()
    chosen = known.where(unit_hash(7, "doc_id") < sample_rows / max(total, 1)).limit(2 * sample_rows)
    rows = docs.select(F.col("doc_id").cast("long"), "text").where("text is not null").join(F.broadcast(chosen), "doc_id")

    def run(it):
        for doc_id, label, text in it:
            yield doc_id, label, indicators(utf8(text)).tobytes()

    features = map_rows(rows.select("doc_id", "label", "text"), "doc_id bigint, label int, buckets binary", run)
    return fit_in_task(features.limit(4 * sample_rows), fit_nbsvm)


def quality_score(spark: SparkSession, model):
    """A column function from texts to scores; a null text scores like an empty one."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        scaled, bias, ratio, slope, offset = sent.value
        margins = (_margin(scaled, bias, ratio, indicators(utf8(text))) for text in texts)
        return pd.Series([1 / (1 + math.exp(-min(max(slope * m + offset, -30.0), 30.0))) for m in margins], dtype="float64")

    return score


def score_quality(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, score, predicted)`` for every row of ``docs`` from its whole text; no shuffle.

    A null text scores like an empty one, by what the model says of no n-grams at all. Repeated rows score alike.
    """
    score = quality_score(docs.sparkSession, model)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def trained_on_folds(spark: SparkSession, sf_dir: str):
    """The model of the query and the pipeline: labels of one fold in five stay unseen."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    return train(table(spark, sf_dir, "documents"), labels)


@query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(table(spark, sf_dir, "documents"), trained_on_folds(spark, sf_dir))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
