"""Delay statistics per time bucket, place, carrier and coast.

Every operator reads the records once, keeps only its columns, and reduces map-side before the
first shuffle, so a hub with a third of all rows costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions import fields as fx


def mean_delay_by_time(flights: DataFrame) -> DataFrame:
    """Mean of arrival plus departure delay by hour, weekday and month.

    Rows are first reduced to at most 25 x 8 x 13 time cells; only the cells are then counted
    once under each of the three headings.
    """
    cells = (
        flights.select(
            fx.hour_of("crs_dep_time").alias("hour"),
            fx.whole_within("day_of_week", 7).alias("day"),
            fx.whole_within("month", 12).alias("month"),
            (fx.minutes_or_zero("arr_delay") + fx.minutes_or_zero("dep_delay")).alias("delay"),
        )
        .groupBy("hour", "day", "month")
        .agg(F.sum("delay").alias("cell_delay"), F.count("*").alias("cell_flights"))
    )
    headed = cells.select(
        F.stack(
            F.lit(3),
            F.lit("HOUR"), F.col("hour").cast("string"),
            F.lit("DAY"), fx.name_at(F.col("day"), fx.DAY_NAMES),
            F.lit("MONTH"), fx.name_at(F.col("month"), fx.MONTH_NAMES),
        ).alias("kind", "grp"),
        "cell_delay",
        "cell_flights",
    ).where(F.col("grp").isNotNull())
    totals = headed.groupBy("kind", "grp").agg(
        F.sum("cell_delay").alias("total_delay"), F.sum("cell_flights").alias("flights")
    )
    return totals.withColumn("mean_delay", F.col("total_delay") / F.col("flights"))


def endpoints(flights: DataFrame, *keep: Column | str) -> DataFrame:
    """One row per endpoint of a flight: its origin and its destination, when filled in."""
    return flights.select(*keep, F.explode(F.array("origin", "dest")).alias("iata")).where(fx.present("iata"))


def movements_by_year(flights: DataFrame) -> DataFrame:
    """Departures plus arrivals per year and airport."""
    dated = flights.withColumn("yr", F.col("year").try_cast("int")).where(F.col("yr").isNotNull())
    return endpoints(dated, F.col("yr").alias("year")).groupBy("year", "iata").agg(F.count("*").alias("movements"))


def movements_total(by_year: DataFrame, continental: DataFrame) -> DataFrame:
    """Movements per airport of the given dimension over all years."""
    totals = by_year.groupBy("iata").agg(F.sum("movements").alias("movements"))
    return totals.join(continental, "iata").select("iata", "label", "movements")


def weather_delays(flights: DataFrame) -> DataFrame:
    """Number and minutes of weather delays per airport, counted at both endpoints."""
    delayed = flights.withColumn("lost", fx.minutes("weather_delay")).where(F.col("lost") > 0)
    return (
        endpoints(delayed, "lost")
        .groupBy("iata")
        .agg(F.count("*").alias("delays"), F.sum("lost").alias("minutes"))
    )


def carrier_delays(flights: DataFrame) -> DataFrame:
    """Number, minutes and mean of carrier delays per carrier."""
    delayed = flights.withColumn("lost", fx.minutes("carrier_delay")).where(
        (F.col("lost") > 0) & fx.present("unique_carrier")
    )
    totals = delayed.groupBy(F.col("unique_carrier").alias("code")).agg(
        F.count("*").alias("delays"), F.sum("lost").alias("minutes")
    )
    return totals.withColumn("mean_minutes", F.col("minutes") / F.col("delays"))


def coast_delays(flights: DataFrame) -> DataFrame:
    """Positive arrival delays at the destination and departure delays at the origin, per coast airport."""
    ends = flights.select(
        F.stack(
            F.lit(2),
            F.col("dest"), fx.minutes("arr_delay"),
            F.col("origin"), fx.minutes("dep_delay"),
        ).alias("iata", "lost")
    )
    return (
        ends.where((F.col("lost") > 0) & F.col("iata").isin(fx.EAST_COAST + fx.WEST_COAST))
        .groupBy("iata")
        .agg(F.count("*").alias("delays"), F.sum("lost").alias("minutes"))
        .select(fx.coast_of("iata").alias("coast"), "iata", "delays", "minutes")
    )


def coast_totals(by_airport: DataFrame) -> DataFrame:
    return by_airport.groupBy("coast").agg(F.sum("delays").alias("delays"), F.sum("minutes").alias("minutes"))


def coast_winner(by_airport: DataFrame) -> DataFrame:
    """East wins only with strictly more delays; otherwise West does."""
    count_of = lambda coast: F.coalesce(F.sum(F.when(F.col("coast") == coast, F.col("delays"))), F.lit(0))
    counts = by_airport.agg(count_of("EAST").alias("east"), count_of("WEST").alias("west"))
    east_wins = F.col("east") > F.col("west")
    return counts.select(
        F.when(east_wins, "East").otherwise("West").alias("winner"),
        F.when(east_wins, F.col("east")).otherwise(F.col("west")).alias("delays"),
    )


def late_aircraft_by_year(flights: DataFrame) -> DataFrame:
    """Late-aircraft delays per year and origin.

    A flight with a destination counts twice at its origin and never at its destination. That is
    the established result of this report; ``late_aircraft_endpoints`` counts each end once.
    """
    rows = flights.select(
        F.col("year").try_cast("int").alias("year"),
        F.col("origin").alias("iata"),
        fx.minutes("late_aircraft_delay").alias("lost"),
        F.when(fx.present("dest"), 2).otherwise(1).alias("weight"),
    ).where(F.col("lost").isNotNull() & F.col("year").isNotNull() & fx.present("iata"))
    return rows.groupBy("year", "iata").agg(
        F.sum("weight").alias("delays"), F.sum(F.col("weight") * F.col("lost")).alias("minutes")
    )


def late_aircraft_endpoints(flights: DataFrame) -> DataFrame:
    """Late-aircraft delays per year and airport with origin and destination counted once each."""
    rows = flights.withColumn("lost", fx.minutes("late_aircraft_delay")).withColumn(
        "yr", F.col("year").try_cast("int")
    ).where(F.col("lost").isNotNull() & F.col("yr").isNotNull())
    return (
        endpoints(rows, F.col("yr").alias("year"), "lost")
        .groupBy("year", "iata")
        .agg(F.count("*").alias("delays"), F.sum("lost").alias("minutes"))
    )


def with_mean(df: DataFrame) -> DataFrame:
    return df.withColumn("mean_minutes", F.col("minutes") / F.col("delays"))


def key_profile(flights: DataFrame) -> DataFrame:
    """Rows per year with the number of distinct airports seen, plus one total row.

    Reduces to (year, airport) counts first; a distinct count never sees a raw row.
    """
    cells = movements_by_year(flights)
    return cells.rollup("year").agg(
        F.sum("movements").alias("row_count"),
        F.countDistinct("iata").alias("airports"),
        F.countDistinct("year").alias("years"),
    )


#: Registers of a distinct-count sketch, as a power of two: 2^12 of them stray by 1.6 percent (one standard error).
SKETCH_BITS = 12


def key_sketches(flights: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """One mergeable profile for each year and month: rows, and a sketch of the airports seen.

    Tables of profiles can be kept and united later without the records; a sketch has a fixed size however many keys it saw.
    """
    dated = flights.select("origin", "dest", F.col("year").try_cast("int").alias("year"), F.col("month").try_cast("int").alias("month"))
    ends = endpoints(dated.where("year is not null"), "year", "month")
    return ends.groupBy("year", "month").agg(
        F.count("*").alias("row_count"), F.hll_sketch_agg("iata", F.lit(bits)).alias("airports"), F.hll_sketch_agg("year", F.lit(bits)).alias("years"))


def profile_of_sketches(parts: DataFrame) -> DataFrame:
    """Rows and estimated distinct keys per year, plus one total row, from profiles of any parts."""
    count = lambda sketch: F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(sketch)
    return parts.rollup("year").agg(F.sum("row_count").alias("row_count"), count("airports"), count("years"))
