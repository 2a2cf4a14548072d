"""User mappers, reducers and aggregates, and profiles from sketches."""

from __future__ import annotations

import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from holdfast.operators import delays, user_code
from tests.test_plans import plan


class Words:
    def map(self, line):
        for word in line.split():
            yield word, len(word)


class Latest:
    """Keeps one row of a key, in arrival order, and says how many there were."""

    def __init__(self):
        self.seen, self.last = 0, None

    def reduce(self, row):
        self.seen, self.last = self.seen + 1, row

    def finish(self):
        yield self.last["k"], self.seen, self.last["v"]


class Spread:
    """Smallest, largest and number: a state that merges in any order."""

    def zero(self):
        return None

    def update(self, state, rows):
        values = rows.column("v")
        mine = (pc.min(values).as_py(), pc.max(values).as_py(), len(values))
        return mine if state is None else self.merge(state, mine)

    def merge(self, left, right):
        return min(left[0], right[0]), max(left[1], right[1]), left[2] + right[2]

    def finish(self, state):
        return state


def test_mapper_makes_any_number_of_rows(spark):
    lines = spark.createDataFrame([("a bb ccc",), ("",), (None,), ("dd",)], "line string")
    got = user_code.map_lines(lines, Words, "word string, size bigint").collect()
    assert sorted(tuple(r) for r in got) == [("a", 1), ("bb", 2), ("ccc", 3), ("dd", 2)]
    assert user_code.map_lines(lines.where("line = 'none'"), Words, "word string, size bigint").count() == 0


def test_reducer_sees_the_rows_of_a_key_in_order(spark):
    rows = spark.range(300).selectExpr("id % 3 AS k", "(id * 7) % 300 AS v").repartition(5)
    got = user_code.reduce_rows(rows, "k", Latest, "k bigint, seen bigint, last bigint", order="v").collect()
    want = {k: max(v for i in range(300) if i % 3 == k for v in [(i * 7) % 300]) for k in range(3)}
    assert {r.k: (r.seen, r.last) for r in got} == {k: (100, v) for k, v in want.items()}


class Shout:
    """One mapper a task; gives its mappings so far beside each line, and nothing for some."""

    def __init__(self):
        self.seen = 0

    def map(self, line):
        self.seen += 1
        if line != "none":
            yield line.upper(), None, {"n": self.seen}


def test_user_rows_travel_in_batches(spark):
    """No Arrow table is made for each line or row, as a table function would."""
    lines = spark.createDataFrame([("a",), ("none",), (None,), ("b",)], "line string").coalesce(1)
    mapped = user_code.map_lines(lines, Shout, "word string, size bigint, seen map<string,bigint>")
    assert [tuple(r) for r in mapped.collect()] == [("A", None, {"n": 1}), ("B", None, {"n": 3})]
    rows = spark.createDataFrame([("a", 1, None), (None, 2, None), (None, 5, None), ("a", 3, None)], "k string, v bigint, t timestamp")
    reduced = user_code.reduce_rows(rows, "k", Latest, "k string, seen bigint, last bigint", order="v")
    assert sorted(map(tuple, reduced.collect()), key=str) == [("a", 2, 3), (None, 2, 5)]
    assert user_code.reduce_rows(rows.where("false"), "k", Latest, "k string, seen bigint, last bigint").count() == 0
    for df in (mapped, reduced):
        assert "PythonUDTF" not in plan(df)


@pytest.mark.parametrize("held", [1, 100_000])
def test_aggregate_on_state(spark, held):
    rows = spark.range(5000).selectExpr("IF(id % 3 = 0, 'hot', CAST(id % 50 AS STRING)) AS k", "id AS v").unionByName(
        spark.createDataFrame([(None, 7), (None, 9)], "k string, v bigint")).repartition(4)
    got = {r.k: (r.lo, r.hi, r.n) for r in user_code.aggregate(rows, "k", Spread(), "lo bigint, hi bigint, n bigint", held).collect()}
    want = {r.k: (r.lo, r.hi, r.n) for r in rows.groupBy("k").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")).collect()}
    assert got == want
    assert user_code.aggregate(rows.where("false"), "k", Spread(), "lo bigint, hi bigint, n bigint").count() == 0


def test_united_sketches_count_many_keys_closely(spark):
    """Ten parts that overlap; four standard errors are allowed."""
    flights = spark.range(400_000).selectExpr(
        "CAST(2000 + id % 2 AS STRING) AS year", "CAST(1 + id % 5 AS STRING) AS month", "CONCAT('A', id % 90000) AS origin", "CONCAT('A', id % 70001) AS dest")
    kept = delays.key_sketches(flights)
    assert kept.count() == 10
    exact = {r.year: (r.row_count, r.airports) for r in delays.key_profile(flights).collect()}
    for r in delays.profile_of_sketches(kept).collect():
        assert r.row_count == exact[r.year][0]
        assert abs(r.airports - exact[r.year][1]) <= 4 * 1.04 / 2 ** (delays.SKETCH_BITS / 2) * exact[r.year][1]
    some = delays.profile_of_sketches(kept.where("month <= 2")).where("year is null").first()
    assert some.row_count == 2 * flights.where("month <= 2").count()
