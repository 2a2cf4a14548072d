"""Views over the given tables, and the record layouts the operators read.

The delay records are a pure projection of ``lineitem`` (no join, no shuffle), spelled as text
the way the CSV files spell them. A third of them touch one hub on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Column order of the on-time CSV files.
FLIGHT_COLUMNS = [
    "year", "month", "day_of_month", "day_of_week", "dep_time", "crs_dep_time", "arr_time",
    "crs_arr_time", "unique_carrier", "flight_num", "tail_num", "actual_elapsed_time",
    "crs_elapsed_time", "air_time", "arr_delay", "dep_delay", "origin", "dest", "distance",
    "taxi_in", "taxi_out", "cancelled", "cancellation_code", "diverted", "carrier_delay",
    "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay",
]

# Airport codes and states by nation number; the last code has no airport row.
AIRPORT_CODES = [
    "IAD", "DCA", "ATL", "BWI", "BOS", "JFK", "EWR", "MIA", "LAX", "SFO", "SEA", "PHX", "LAS",
    "SLC", "SAN", "ORD", "DFW", "DEN", "IAH", "MSP", "DTW", "ANC", "HNL", "SJU", "ZZZ",
]
AIRPORT_STATES = [
    "VA", "VA", "GA", "MD", "MA", "NY", "NJ", "FL", "CA", "CA", "WA", "AZ", "NV",
    "UT", "CA", "IL", "TX", "CO", "TX", "MN", "MI", "AK", "HI", "PR", "",
]
HUB = "ATL"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def flight_records(spark: SparkSession, sf_dir: str, keys: bool = False) -> DataFrame:
    """On-time records as text columns; ``keys`` keeps the line-item columns for row output."""
    li = table(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity").cast("int")
    old = F.year("l_shipdate") < 1998

    def delay(missing: Column, value: Column) -> Column:
        return F.when(missing, "NA").otherwise(value.cast("string"))

    def above(limit: int) -> Column:
        return F.greatest(quantity - limit, F.lit(0))

    values = {
        "year": F.year("l_shipdate").cast("string"),
        "month": F.month("l_shipdate").cast("string"),
        "day_of_month": F.dayofmonth("l_shipdate").cast("string"),
        "day_of_week": F.extract(F.lit("DOW_ISO"), F.col("l_shipdate")).cast("string"),
        "crs_dep_time": (
            F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13, F.lit(24)) * 100
            + F.pmod(F.col("l_partkey"), F.lit(64))
        ).cast("string"),
        "unique_carrier": F.concat(F.lit("C"), (F.col("l_suppkey") % 12).cast("string")),
        "arr_delay": delay(F.col("l_linenumber") == 7, quantity - 20),
        "dep_delay": delay((F.col("l_linenumber") == 7) | (F.col("l_returnflag") == "R"), quantity - 22),
        "origin": F.when(F.col("l_orderkey") % 41 == 0, "")
        .when(quantity % 3 == 0, HUB)
        .otherwise(_pick(AIRPORT_CODES, F.col("l_suppkey") % 25)),
        "dest": F.when(F.col("l_orderkey") % 37 == 0, "").otherwise(_pick(AIRPORT_CODES, F.col("l_partkey") % 25)),
        "carrier_delay": delay(old, above(30)),
        "weather_delay": delay(old, above(42)),
        "late_aircraft_delay": delay(old, F.when(F.col("l_linenumber") > 3, quantity).otherwise(F.lit(0))),
    }
    kept = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"] if keys else []
    return li.select(*kept, *[values.get(c, F.lit("")).alias(c) for c in FLIGHT_COLUMNS])


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport dimension: one row for every nation. The last has a code of its own, so flights to ZZZ match none."""
    number = F.col("n_nationkey")
    city = F.when(number == 19, "").otherwise(F.col("n_name"))
    return (
        table(spark, sf_dir, "nation")
        .select(
            F.when(number == 24, "XNA").otherwise(_pick(AIRPORT_CODES, number)).alias("iata"),
            F.concat(F.col("n_name"), F.when(number == 2, " Hartsfield, Main").otherwise(" Field")).alias("airport"),
            city.alias("city"),
            _pick(AIRPORT_STATES, number).alias("state"),
        )
    )


def airport_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport rows as a feed with many rows per code, gaps and awkward names; grows with ``customer``."""
    key = F.col("c_custkey")
    slot = key % 25
    return table(spark, sf_dir, "customer").select(
        key.alias("load_order"),
        F.when(key % 53 == 0, "").otherwise(_pick(AIRPORT_CODES, slot)).alias("iata"),
        F.when(key % 7 == 0, F.concat(F.col("c_name"), F.lit(", \"Main\" Field")))
        .when(key % 29 == 0, "")
        .otherwise(F.col("c_name"))
        .alias("airport"),
        F.when(key % 19 == 0, "").otherwise(F.initcap("c_mktsegment")).alias("city"),
        F.when(key % 23 == 0, "NewYork").otherwise(_pick(AIRPORT_STATES, slot)).alias("state"),
    )


def carrier_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carrier rows as a feed with several rows per code; code ``C11`` is never described."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("load_order"),
        F.concat(F.lit("C"), (key % 12).cast("string")).alias("code"),
        F.when(key % 12 == 11, "").otherwise(F.col("s_name")).alias("description"),
    )
