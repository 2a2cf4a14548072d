"""Bodies from many sources to many targets, in a number of rows that stays far below sources times targets.

Up to ``direct`` targets every source writes one row to each. Beyond that a source writes to lanes of about
the square root of the targets, packed; the sources of a lane are then brought together in groups, each of
which writes one packed row to every target of the lane.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.blocks import squeeze, unsqueeze

DIRECT = 4_096


def _lane(target, lanes: int):
    mixed = np.asarray(target, np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(lanes)).astype(np.int64)


@dataclass(frozen=True)
class Route:
    """One way for ``(target, source, body)`` rows; ``lanes`` is 0 where each goes on its own."""

    lanes: int

    @staticmethod
    def to(targets: int, direct: int = DIRECT) -> Route:
        return Route(0 if targets <= direct else math.ceil(math.sqrt(targets)))

    @property
    def schema(self) -> str:
        return "lane bigint, source bigint, pack binary" if self.lanes else "target bigint, source bigint, body binary"

    def leaving(self, rows: Iterable[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
        """What one source call writes, given its rows for all targets."""
        if not self.lanes:
            yield from rows
            return
        rows = list(rows)
        lane = _lane([r[0] for r in rows], self.lanes)
        for one in np.unique(lane):
            mine = [rows[i] for i in np.flatnonzero(lane == one)]
            yield int(one), mine[0][1], squeeze(mine)

    def frame(self, rows: Iterable[tuple[int, int, bytes]]) -> pd.DataFrame:
        names = [part.split(" ")[0] for part in self.schema.split(", ")]
        return pd.DataFrame(list(self.leaving(rows)), columns=names)

    def grouped(self, sent: DataFrame):
        """``sent`` grouped by target."""
        if not self.lanes:
            return sent.groupBy("target")
        groups = F.pmod(F.xxhash64("source"), F.lit(self.lanes)).alias("some")

        def regroup(rows: pd.DataFrame) -> pd.DataFrame:
            held: dict[int, list] = {}
            for pack in rows["pack"]:
                for target, source, body in unsqueeze(pack):
                    held.setdefault(target, []).append((source, body))
            return pd.DataFrame({"target": list(held), "pack": [squeeze(h) for h in held.values()]}).astype({"target": "int64"})

        return sent.withColumn("some", groups).groupBy("lane", "some").applyInPandas(regroup, "target bigint, pack binary").groupBy("target")

    @staticmethod
    def arrived(rows: pd.DataFrame) -> tuple[list[int], list[bytes]]:
        """Sources and bodies that came to one target."""
        if "pack" in rows:
            both = [item for pack in rows["pack"] for item in unsqueeze(pack)]
            return [source for source, _ in both], [body for _, body in both]
        return [int(s) for s in rows["source"]], [bytes(b) for b in rows["body"]]
