"""Sectioned text reports as rows ``(section, rank, line)``; order by section, then rank.

A line is a key and a value with a tab between them, as a text sink writes a pair. Rank -1 is the
empty pair before a section, 0 its heading, 1 and up its entries.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK, HEADING = -1, 0
OVERALL, WORST = 9998, 9999

# The wording of the reports.
TITLES = {
    "q01": ("QUESTION 1: ", "What is the best time-of-the-day/day-of-week/time-of-year to fly to minimize delays?"),
    "q03": ("QUESTION 3: ", "What are the major hubs (busiest airports) in continental U.S.? Has there been a change over the 21-year period covered by this dataset?"),
    "q03_overall": ("QUESTION 3 (continued): ", "What are the major hubs (busiest airports) in continental U.S.? Please list the top 10."),
    "q04": ("QUESTION 4: ", "Which cities experience the most weather related delays? Please list the top 10."),
    "q05": ("QUESTION 5: ", "Which carriers have the most delays?"),
    "q05_worst": ("Which carrier has the highest average delay?", ""),
    "q06": ("QUESTION 6: ", "Do East or West coast airports have more delays?"),
    "q07_aspects": ("QUESTION 7: ", "What are the aspects that you can infer from the LateAircraftDelay field?"),
    "q07": ("QUESTION 7: ", "What are the airports with the most delays due to Late Aircrafts? Has there been a change over the 21-year period covered by this dataset?"),
    "q07_overall": ("Which airlines experience the most late aircraft related delays? ", "Please list the top 10."),
    "q07_worst": ("Which city has the highest average late aircraft delay across all data?", ""),
}
ORDERED = "(ordered from best to worst):"
MOVEMENTS = [("Number of Flights", "movements")]
WEATHER = [("Total Number of Weather Delays", "delays"), ("Total Number of Minutes of Lost to Weather Delays", "minutes")]
CARRIER = [
    ("Total Number of Carrier Delays", "delays"),
    ("Total Number of Minutes that were Lost to Delays", "minutes"),
    ("Average Number of Minutes that were Lost to Delays", "mean_minutes"),
]
COAST = [("Total Number of Delays", "delays"), ("Total Number of Minutes that were Lost to Delays", "minutes")]
LATE = [
    ("Total Number of Late Aircrafts", "delays"),
    ("Total Number of Minutes that were Lost to Late Aircrafts", "minutes"),
    ("Average Number of Minutes that were Lost to Late Aircrafts", "mean_minutes"),
]


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("null"))


def _whole(value: int | str) -> Column:
    return (F.lit(value) if isinstance(value, int) else F.col(value)).cast("bigint")


def _place(code: str, label: str) -> list[Column]:
    return [F.lit("("), _text(code), F.lit(") "), _text(label)]


def _measures(measures: list[tuple[str, str]]) -> list[Column]:
    return [part for title, name in measures for part in (F.lit(f"\t{title}:\t"), _text(name))]


def _entries(df: DataFrame, section: int | str, measures: list[tuple[str, str]], code: str = "iata", label: str = "label") -> DataFrame:
    """Numbered lines of ranked rows."""
    line = F.concat(_text("rank"), F.lit(": "), *_place(code, label), *_measures(measures))
    return df.select(_whole(section).alias("section"), "rank", line.alias("line"))


def _single(df: DataFrame, section: int, measures: list[tuple[str, str]], code: str = "iata", label: str = "label") -> DataFrame:
    """The line of a one-row result, without a number."""
    return df.select(
        _whole(section).alias("section"), _whole(1).alias("rank"),
        F.concat(*_place(code, label), *_measures(measures)).alias("line"),
    )


def _fixed(like: DataFrame, *rows: tuple[int, int, tuple[str, str]]) -> DataFrame:
    lines = [
        F.struct(_whole(s).alias("section"), _whole(r).alias("rank"), F.lit("\t".join(pair)).alias("line"))
        for s, r, pair in rows
    ]
    return like.sparkSession.range(1).select(F.inline(F.array(*lines)))


def _year_heads(entries: DataFrame) -> DataFrame:
    """An empty pair and a heading for every year present."""
    marks = F.explode(F.array(_whole(BLANK), _whole(HEADING)))
    years = entries.select("section").distinct().select("section", marks.alias("rank"))
    heading = F.concat(F.lit("Year: \t"), F.col("section").cast("string"))
    return years.select("section", "rank", F.when(F.col("rank") == BLANK, "\t").otherwise(heading).alias("line"))


def _join(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


EMPTY = ("", "")


def time_report(ranked: DataFrame) -> DataFrame:
    """Hours, weekdays and months from best to worst mean delay."""
    kind = F.col("kind")
    label = F.when(kind == "HOUR", F.concat(F.lit("HOUR "), F.col("grp"))).otherwise(F.concat(F.col("grp"), F.lit("\t")))
    lines = ranked.select(
        F.when(kind == "HOUR", 1).when(kind == "DAY", 2).otherwise(3).cast("bigint").alias("section"),
        "rank",
        F.concat(label, F.lit("\tDELAY:\t"), _text("mean_delay")).alias("line"),
    )
    heads = [(0, HEADING, TITLES["q01"])]
    for number, title in enumerate(["Time-of-the-day", "Day-of-week", "Time-of-year"], start=1):
        heads += [(number, BLANK, EMPTY), (number, HEADING, (title, ORDERED))]
    return _join(lines, _fixed(ranked, *heads))


def movement_report(per_year: DataFrame, overall: DataFrame) -> DataFrame:
    """Busiest airports of each year, then of all years."""
    years = _entries(per_year, "year", MOVEMENTS)
    heads = _fixed(per_year, (0, HEADING, TITLES["q03"]), (OVERALL, BLANK, EMPTY), (OVERALL, HEADING, TITLES["q03_overall"]))
    return _join(years, _year_heads(years), _entries(overall, OVERALL, MOVEMENTS), heads)


def weather_report(top: DataFrame) -> DataFrame:
    return _join(_entries(top, 1, WEATHER), _fixed(top, (0, HEADING, TITLES["q04"])))


def carrier_report(top: DataFrame, worst: DataFrame) -> DataFrame:
    """Carriers with most delays, then the one with the highest mean."""
    return _join(
        _entries(top, 1, CARRIER, "code", "description"),
        _single(worst, 2, CARRIER, "code", "description"),
        _fixed(top, (0, HEADING, TITLES["q05"]), (2, HEADING, TITLES["q05_worst"])),
    )


def coast_report(totals: DataFrame, ranked: DataFrame, winner: DataFrame) -> DataFrame:
    """Totals and ranked airports of each coast, then the coast with more delays."""
    east = F.col("coast") == "EAST"
    name = F.when(east, "East").otherwise("West")
    total_line = lambda rank, title, measure: F.struct(
        _whole(rank).alias("rank"), F.concat(name, F.lit(f" Coast Airports:\t{title}: "), _text(measure)).alias("line"))
    summary = totals.select(
        F.when(east, 1).otherwise(3).cast("bigint").alias("section"),
        F.inline(F.array(total_line(1, "Total Number of Minutes Lost to Delays", "minutes"), total_line(2, "Total Number of Delays", "delays"))),
    )
    lists = _entries(ranked.withColumn("section", F.when(east, 2).otherwise(4)), "section", COAST)
    verdict = winner.select(
        _whole(5).alias("section"), _whole(1).alias("rank"),
        F.concat(F.col("winner"), F.lit(" Coast airports have more Delays.\tTotal number of delayed flights: "), _text("delays")).alias("line"),
    )
    blanks = [(section, BLANK, EMPTY) for section in (1, 2, 3, 4, 5)]
    return _join(summary, lists, verdict, _fixed(totals, (0, HEADING, TITLES["q06"]), *blanks))


def late_aircraft_report(per_year: DataFrame, overall: DataFrame, worst: DataFrame) -> DataFrame:
    """Airports with most late aircraft per year and overall, then the one with the highest mean."""
    years = _entries(per_year, "year", LATE)
    heads = _fixed(
        per_year, (0, HEADING, TITLES["q07_aspects"]), (0, 1, TITLES["q07"]),
        (OVERALL, BLANK, EMPTY), (OVERALL, HEADING, TITLES["q07_overall"]),
        (WORST, BLANK, EMPTY), (WORST, HEADING, TITLES["q07_worst"]),
    )
    return _join(years, _year_heads(years), _entries(overall, OVERALL, LATE), _single(worst, WORST, LATE), heads)
