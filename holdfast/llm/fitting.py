"""Fitting a small model in one task on a bounded sample of rows, and sampling by hashes."""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import map_rows


def unit_hash(seed: int, *columns: str) -> Column:
    """A number in [0, 1) from a hash of ``columns``; the same for the same values, wherever it runs."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) / float(1 << 52)


def fit_in_task(features: DataFrame, fit: Callable[[list[tuple]], object]) -> object:
    """``fit`` over all rows of ``features``, in one task; the caller bounds the rows. The model comes back."""

    def run(rows):
        yield (pickle.dumps(fit(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:])))),)

    made = map_rows(features.repartition(1), "model binary", run).first()
    return pickle.loads(made[0]) if made else fit([])  # Spark may run no task at all over no rows
