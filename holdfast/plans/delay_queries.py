"""Registered queries over delay records."""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions import fields as fx
from holdfast.operators import delays, places, ranking, reports, user_code
from holdfast.plans.delay_sql import (
    AIRPORTS, CARRIER_TOTALS, CARRIERS, COASTS, ENDS, FLIGHTS, LATE, LISTINGS, TIMES, _EAST, _WEST, stmt,
)
from holdfast.plans.registry import ORACLES, query
from holdfast.session import fresh_path, staged
from holdfast.sources import csv_files
from holdfast.sources import tables as src

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEY_SQL = "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey"


def _keys() -> list:
    return ["l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey"]


def _big(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})


# ---- sources and sinks -------------------------------------------------------------------------

@query("src_flights_csv", stmt(FLIGHTS, body="""
SELECT unique_carrier, count(*) AS flights, count(try_cast(arr_delay AS DOUBLE)) AS with_arrival,
  coalesce(sum(try_cast(arr_delay AS DOUBLE)), 0) AS arrival_minutes, count(NULLIF(origin, '')) AS with_origin
FROM flights GROUP BY unique_carrier"""))
def src_flights_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "flights-csv")
    csv_files.write_flights(src.flight_records(spark, sf), path)
    back = csv_files.read_flights(spark, path)
    return back.groupBy("unique_carrier").agg(
        F.count("*").alias("flights"),
        F.count(fx.minutes("arr_delay")).alias("with_arrival"),
        F.coalesce(F.sum(fx.minutes("arr_delay")), F.lit(0.0)).alias("arrival_minutes"),
        F.count(F.when(fx.present("origin"), 1)).alias("with_origin"),
    )


@query("src_dim_csv", stmt(LISTINGS, body="SELECT load_order, iata, airport, city, state FROM listings"))
def src_dim_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "dim-csv")
    columns = ["load_order", "iata", "airport", "city", "state"]
    csv_files.write_dimension(src.airport_listings(spark, sf).select(*columns), path)
    return _big(csv_files.read_dimension(spark, path, columns), "load_order")


@query("sink_report", stmt(FLIGHTS, AIRPORTS, ENDS, body="SELECT year, iata, movements FROM moves"))
def sink_report(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "movements")
    _movements(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


# ---- projections and filters --------------------------------------------------------------------

@query("flt_missing_as_zero", stmt(FLIGHTS, body=f"""
SELECT {KEY_SQL}, coalesce(try_cast(arr_delay AS DOUBLE), 0) + coalesce(try_cast(dep_delay AS DOUBLE), 0) AS delay
FROM flights"""))
def flt_missing_as_zero(spark: SparkSession, sf: str) -> DataFrame:
    return src.flight_records(spark, sf, keys=True).select(
        *_keys(), (fx.minutes_or_zero("arr_delay") + fx.minutes_or_zero("dep_delay")).alias("delay")
    )


@query("flt_positive_delay", stmt(FLIGHTS, body=f"""
SELECT {KEY_SQL}, CAST(weather_delay AS DOUBLE) AS minutes FROM flights WHERE try_cast(weather_delay AS DOUBLE) > 0"""))
def flt_positive_delay(spark: SparkSession, sf: str) -> DataFrame:
    rows = src.flight_records(spark, sf, keys=True).withColumn("minutes", fx.minutes("weather_delay"))
    return rows.where(F.col("minutes") > 0).select(*_keys(), "minutes")


@query("flt_present_delay", stmt(FLIGHTS, body=f"""
SELECT {KEY_SQL}, CAST(late_aircraft_delay AS DOUBLE) AS minutes FROM flights
WHERE try_cast(late_aircraft_delay AS DOUBLE) IS NOT NULL"""))
def flt_present_delay(spark: SparkSession, sf: str) -> DataFrame:
    rows = src.flight_records(spark, sf, keys=True).withColumn("minutes", fx.minutes("late_aircraft_delay"))
    return rows.where(F.col("minutes").isNotNull()).select(*_keys(), "minutes")


@query("flt_min_fields", """
WITH lines AS (
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
    rtrim(repeat(l_returnflag || ',', CAST(l_quantity AS INT) % 31) || CASE WHEN l_partkey % 2 = 0 THEN '' ELSE 'x' END, ',') AS line
  FROM lineitem),
counted AS (
  SELECT * EXCLUDE line, CASE WHEN line = '' THEN 1 ELSE length(line) - length(replace(line, ',', '')) + 1 END AS n FROM lines)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(n AS BIGINT) AS fields,
  n >= 26 AS has_weather, n >= 25 AS has_carrier, n >= 18 AS has_ends, n >= 29 AS has_late_aircraft FROM counted""")
def flt_min_fields(spark: SparkSession, sf: str) -> DataFrame:
    line = F.concat(
        F.repeat(F.concat("l_returnflag", F.lit(",")), F.col("l_quantity").cast("int") % 31),
        F.when(F.col("l_partkey") % 2 == 0, "").otherwise("x"),
    )
    n = F.col("fields")
    return (
        src.table(spark, sf, "lineitem")
        .select(*_keys(), csv_files.field_count(line).alias("fields"))
        .select("*", (n >= 26).alias("has_weather"), (n >= 25).alias("has_carrier"),
                (n >= 18).alias("has_ends"), (n >= 29).alias("has_late_aircraft"))
    )


@query("prj_hour_bucket", stmt(FLIGHTS, body=f"""
SELECT {KEY_SQL}, CASE WHEN CAST(right(lpad(crs_dep_time, 4, '0'), 2) AS INT) < 60
  THEN CAST(left(lpad(crs_dep_time, 4, '0'), 2) AS BIGINT) END AS hour FROM flights"""))
def prj_hour_bucket(spark: SparkSession, sf: str) -> DataFrame:
    rows = src.flight_records(spark, sf, keys=True)
    return rows.select(*_keys(), fx.hour_of("crs_dep_time").cast("bigint").alias("hour"))


@query("prj_day_month_name", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_quantity BETWEEN 1 AND 7 THEN upper(dayname(DATE '2023-12-31' + CAST(l_quantity AS INT))) END AS day_name,
  CASE WHEN l_quantity BETWEEN 1 AND 12 THEN upper(monthname(make_date(2024, CAST(l_quantity AS INT), 1))) END AS month_name
FROM lineitem""")
def prj_day_month_name(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("l_quantity").cast("int").cast("string")
    return src.table(spark, sf, "lineitem").select(
        *_keys(), fx.day_name(number).alias("day_name"), fx.month_name(number).alias("month_name")
    )


@query("prj_airport_label", stmt(LISTINGS, body="""
SELECT load_order, iata, airport || ', located in ' || city || ', ' || state AS label FROM listings"""))
def prj_airport_label(spark: SparkSession, sf: str) -> DataFrame:
    return src.airport_listings(spark, sf).select(
        "load_order", "iata", fx.airport_label("airport", "city", "state").alias("label")
    )


@query("flt_continental", stmt(LISTINGS, body="""
SELECT load_order, iata, airport, city, state FROM listings
WHERE length(state) = 2 AND state <> 'HI' AND state <> 'AK' AND airport <> '' AND city <> ''"""))
def flt_continental(spark: SparkSession, sf: str) -> DataFrame:
    rows = src.airport_listings(spark, sf).where(fx.is_continental("airport", "city", "state"))
    return rows.select("load_order", "iata", "airport", "city", "state")


@query("flt_complete_dim", stmt(LISTINGS, body="""
SELECT load_order, iata, airport, city, state FROM listings
WHERE iata <> '' AND airport <> '' AND city <> '' AND state <> ''"""))
def flt_complete_dim(spark: SparkSession, sf: str) -> DataFrame:
    rows = src.airport_listings(spark, sf).where(fx.all_present("iata", "airport", "city", "state"))
    return rows.select("load_order", "iata", "airport", "city", "state")


@query("prj_coast_class", stmt(FLIGHTS, body=f"""
SELECT {KEY_SQL}, CASE WHEN dest IN {_EAST} THEN 'EAST' WHEN dest IN {_WEST} THEN 'WEST' END AS coast FROM flights
WHERE dest IN {_EAST} OR dest IN {_WEST}"""))
def prj_coast_class(spark: SparkSession, sf: str) -> DataFrame:
    rows = src.flight_records(spark, sf, keys=True).select(*_keys(), fx.coast_of("dest").alias("coast"))
    return rows.where(F.col("coast").isNotNull())


@query("prj_unpivot_endpoints", stmt(FLIGHTS, body=f"""
SELECT {KEY_SQL}, origin AS iata FROM flights WHERE origin <> ''
UNION ALL SELECT {KEY_SQL}, dest FROM flights WHERE dest <> ''"""))
def prj_unpivot_endpoints(spark: SparkSession, sf: str) -> DataFrame:
    return delays.endpoints(src.flight_records(spark, sf, keys=True), *_keys())


@query("prj_kv_parse", stmt(FLIGHTS, body=f"""
SELECT {KEY_SQL}, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE try_cast(arr_delay AS DOUBLE) END AS delay_total,
  CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_suppkey END AS num_flights FROM flights"""))
def prj_kv_parse(spark: SparkSession, sf: str) -> DataFrame:
    rows = src.flight_records(spark, sf, keys=True)
    payload = F.concat(
        F.when(F.col("l_partkey") % 5 == 0, "DELAYTOTAL:1:2,").otherwise(""),
        F.when(F.col("l_partkey") % 5 != 0, F.concat(F.lit("DELAYTOTAL:"), "arr_delay", F.lit(","))).otherwise("junk,"),
        F.lit("NUMFLIGHTS:"),
        F.when(F.col("l_partkey") % 7 == 0, "").otherwise(F.col("l_suppkey").cast("string")),
    )
    parsed = rows.withColumn("payload", payload).select(
        *_keys(),
        fx.payload_value("payload", "DELAYTOTAL").alias("total"),
        fx.payload_value("payload", "NUMFLIGHTS").alias("flights"),
    )
    return parsed.select(
        *KEYS, fx.minutes("total").alias("delay_total"), F.col("flights").try_cast("bigint").alias("num_flights")
    )


@query("prj_hex_roundtrip", """
SELECT c_custkey, upper(sha1(c_name)) AS digest, sha1(c_name) = lower(hex(unhex(sha1(c_name)))) AS same,
  CAST(('0x' || substr(sha1(c_name), 1, 8)) AS BIGINT) AS head FROM customer""")
def prj_hex_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    digest = F.sha1(F.col("c_name").cast("binary"))
    return src.table(spark, sf, "customer").select("c_custkey", digest.alias("d")).select(
        "c_custkey",
        F.upper("d").alias("digest"),
        (F.lower(F.hex(F.unhex("d"))) == F.col("d")).alias("same"),
        fx.hex_to_int(F.substring("d", 1, 8)).alias("head"),
    )


# ---- mean delay by time -------------------------------------------------------------------------

@query("q01_mean_delay", stmt(FLIGHTS, TIMES, body="SELECT kind, grp, total_delay, flights, mean_delay FROM means"))
def q01_mean_delay(spark: SparkSession, sf: str) -> DataFrame:
    return delays.mean_delay_by_time(src.flight_records(spark, sf))


@query("q01_ranked", stmt(FLIGHTS, TIMES, body="""
SELECT kind, grp, mean_delay, row_number() OVER (PARTITION BY kind ORDER BY mean_delay, grp) AS rank FROM means"""))
def q01_ranked(spark: SparkSession, sf: str) -> DataFrame:
    means = delays.mean_delay_by_time(src.flight_records(spark, sf)).select("kind", "grp", "mean_delay")
    return ranking.ranked_within(means, "kind", F.asc("mean_delay"), F.asc("grp"))


# ---- movements ----------------------------------------------------------------------------------

def _movements(spark: SparkSession, sf: str) -> DataFrame:
    return _big(delays.movements_by_year(src.flight_records(spark, sf)), "year")


def _continental(spark: SparkSession, sf: str) -> DataFrame:
    return places.continental(src.airports(spark, sf))


def _complete(spark: SparkSession, sf: str) -> DataFrame:
    return places.complete(src.airports(spark, sf))



@query("q03_year_airport_counts", stmt(FLIGHTS, AIRPORTS, ENDS, body="SELECT year, iata, movements FROM moves"))
def q03_year_airport_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _movements(spark, sf)


@query("q03_total_by_airport", stmt(FLIGHTS, AIRPORTS, ENDS, body="SELECT iata, label, CAST(movements AS BIGINT) AS movements FROM totals"))
def q03_total_by_airport(spark: SparkSession, sf: str) -> DataFrame:
    return delays.movements_total(_movements(spark, sf), _continental(spark, sf))


@query("q03_top10_per_year", stmt(FLIGHTS, AIRPORTS, ENDS, body="""
SELECT year, rank, iata, label, movements FROM (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY movements DESC, iata) AS rank FROM moves)
LEFT JOIN continental USING (iata) WHERE rank <= 10"""))
def q03_top10_per_year(spark: SparkSession, sf: str) -> DataFrame:
    top = ranking.top_k_per_group(_movements(spark, sf), "year", 10, F.desc("movements"), F.asc("iata"))
    return top.join(_continental(spark, sf), "iata", "left").select("year", "rank", "iata", "label", "movements")


@query("q03_top10_overall", stmt(FLIGHTS, AIRPORTS, ENDS, body="""
SELECT row_number() OVER (ORDER BY movements DESC, iata) AS rank, iata, label, CAST(movements AS BIGINT) AS movements
FROM totals ORDER BY movements DESC, iata LIMIT 10"""))
def q03_top10_overall(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_k(q03_total_by_airport(spark, sf), 10, F.desc("movements"), F.asc("iata"))


@query("q03_flat_export", stmt(FLIGHTS, AIRPORTS, ENDS, body="SELECT year, iata, movements, label FROM moves JOIN continental USING (iata)"))
def q03_flat_export(spark: SparkSession, sf: str) -> DataFrame:
    return _movements(spark, sf).join(_continental(spark, sf), "iata").select("year", "iata", "movements", "label")


@query("prof_key_counts", stmt(FLIGHTS, AIRPORTS, ENDS, body="""
SELECT year, CAST(sum(movements) AS BIGINT) AS row_count, count(DISTINCT iata) AS airports, count(DISTINCT year) AS years
FROM moves GROUP BY ROLLUP (year)"""))
def prof_key_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _big(delays.key_profile(src.flight_records(spark, sf)), "year")


@query("join_inner_airport", stmt(FLIGHTS, AIRPORTS, body=f"""
SELECT {KEY_SQL}, origin, label FROM flights JOIN complete ON origin = iata"""))
def join_inner_airport(spark: SparkSession, sf: str) -> DataFrame:
    rows = src.flight_records(spark, sf, keys=True).select(*_keys(), "origin")
    return rows.join(_complete(spark, sf).withColumnRenamed("iata", "origin"), "origin").select(*KEYS, "origin", "label")


@query("join_left_airport", stmt(FLIGHTS, AIRPORTS, body=f"""
SELECT {KEY_SQL}, dest, label FROM flights LEFT JOIN complete ON dest = iata"""))
def join_left_airport(spark: SparkSession, sf: str) -> DataFrame:
    rows = src.flight_records(spark, sf, keys=True).select(*_keys(), "dest")
    return rows.join(_complete(spark, sf).withColumnRenamed("iata", "dest"), "dest", "left").select(*KEYS, "dest", "label")


@query("join_left_carrier", stmt(FLIGHTS, CARRIERS, body=f"""
SELECT {KEY_SQL}, unique_carrier, description FROM flights LEFT JOIN carriers ON unique_carrier = code"""))
def join_left_carrier(spark: SparkSession, sf: str) -> DataFrame:
    rows = src.flight_records(spark, sf, keys=True).select(*_keys(), "unique_carrier")
    # every record meets the names, so their real size decides how
    names = staged(places.carriers(src.carrier_listings(spark, sf)), "carriers").withColumnRenamed("code", "unique_carrier")
    return rows.join(names, "unique_carrier", "left").select(*KEYS, "unique_carrier", "description")


@query("dim_last_wins", stmt(LISTINGS, body="""
SELECT iata, arg_max(airport, load_order) AS airport, max(load_order) AS load_order FROM listings GROUP BY iata"""))
def dim_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    return places.last_wins(src.airport_listings(spark, sf), "iata", "airport", "load_order")


# ---- weather, carrier and coast -----------------------------------------------------------------

@query("q04_weather_by_airport", stmt(FLIGHTS, AIRPORTS, ENDS, body="SELECT iata, delays, minutes FROM weather"))
def q04_weather_by_airport(spark: SparkSession, sf: str) -> DataFrame:
    return delays.weather_delays(src.flight_records(spark, sf))


@query("q04_top10_weather", stmt(FLIGHTS, AIRPORTS, ENDS, body="""
SELECT rank, iata, label, delays, minutes FROM (
  SELECT *, row_number() OVER (ORDER BY delays DESC, iata) AS rank FROM weather) LEFT JOIN complete USING (iata)
WHERE rank <= 10"""))
def q04_top10_weather(spark: SparkSession, sf: str) -> DataFrame:
    top = ranking.top_k(q04_weather_by_airport(spark, sf), 10, F.desc("delays"), F.asc("iata"))
    return top.join(_complete(spark, sf), "iata", "left").select("rank", "iata", "label", "delays", "minutes")


@query("q05_carrier_delay", stmt(FLIGHTS, CARRIER_TOTALS, body="SELECT code, delays, minutes, mean_minutes FROM ct"))
def q05_carrier_delay(spark: SparkSession, sf: str) -> DataFrame:
    return delays.carrier_delays(src.flight_records(spark, sf))


@query("q05_top10_carriers", stmt(FLIGHTS, CARRIERS, CARRIER_TOTALS, body="""
SELECT rank, code, description, delays, minutes, mean_minutes FROM (
  SELECT *, row_number() OVER (ORDER BY delays DESC, code) AS rank FROM ct) LEFT JOIN carriers USING (code)
WHERE rank <= 10"""))
def q05_top10_carriers(spark: SparkSession, sf: str) -> DataFrame:
    top = ranking.top_k(q05_carrier_delay(spark, sf), 10, F.desc("delays"), F.asc("code"))
    names = places.carriers(src.carrier_listings(spark, sf))
    return top.join(names, "code", "left").select("rank", "code", "description", "delays", "minutes", "mean_minutes")


@query("q05_worst_mean", stmt(FLIGHTS, CARRIERS, CARRIER_TOTALS, body="""
SELECT code, description, delays, minutes, mean_minutes FROM ct LEFT JOIN carriers USING (code)
ORDER BY mean_minutes DESC, code LIMIT 1"""))
def q05_worst_mean(spark: SparkSession, sf: str) -> DataFrame:
    worst = q05_carrier_delay(spark, sf).orderBy(F.desc("mean_minutes"), F.asc("code")).limit(1)
    names = places.carriers(src.carrier_listings(spark, sf))
    return worst.join(names, "code", "left").select("code", "description", "delays", "minutes", "mean_minutes")


@query("q06_coast_airports", stmt(FLIGHTS, COASTS, body="SELECT coast, iata, delays, minutes FROM coast"))
def q06_coast_airports(spark: SparkSession, sf: str) -> DataFrame:
    return delays.coast_delays(src.flight_records(spark, sf))


@query("q06_coast_totals", stmt(FLIGHTS, COASTS, body="""
SELECT coast, CAST(sum(delays) AS BIGINT) AS delays, sum(minutes) AS minutes FROM coast GROUP BY coast"""))
def q06_coast_totals(spark: SparkSession, sf: str) -> DataFrame:
    return delays.coast_totals(q06_coast_airports(spark, sf))


@query("q06_ranked_airports", stmt(FLIGHTS, AIRPORTS, COASTS, body="""
SELECT coast, row_number() OVER (PARTITION BY coast ORDER BY delays DESC, iata) AS rank, iata, label, delays, minutes
FROM coast JOIN complete USING (iata)"""))
def q06_ranked_airports(spark: SparkSession, sf: str) -> DataFrame:
    named = q06_coast_airports(spark, sf).join(_complete(spark, sf), "iata")
    ranked = ranking.ranked_within(named, "coast", F.desc("delays"), F.asc("iata"))
    return ranked.select("coast", "rank", "iata", "label", "delays", "minutes")


@query("q06_winner", stmt(FLIGHTS, COASTS, body="""
SELECT CASE WHEN e > w THEN 'East' ELSE 'West' END AS winner, CAST(CASE WHEN e > w THEN e ELSE w END AS BIGINT) AS delays
FROM (SELECT coalesce(sum(delays) FILTER (coast = 'EAST'), 0) AS e, coalesce(sum(delays) FILTER (coast = 'WEST'), 0) AS w FROM coast)"""))
def q06_winner(spark: SparkSession, sf: str) -> DataFrame:
    return delays.coast_winner(q06_coast_airports(spark, sf))


# ---- late aircraft ------------------------------------------------------------------------------

def _late(spark: SparkSession, sf: str) -> DataFrame:
    return _big(delays.late_aircraft_by_year(src.flight_records(spark, sf)), "year")


@query("q07_late_aircraft_year", stmt(FLIGHTS, AIRPORTS, LATE, body="""
SELECT year, iata, CAST(delays AS BIGINT) AS delays, minutes, minutes / delays AS mean_minutes FROM late"""))
def q07_late_aircraft_year(spark: SparkSession, sf: str) -> DataFrame:
    return delays.with_mean(_late(spark, sf))


@query("q07_late_aircraft_total", stmt(FLIGHTS, AIRPORTS, LATE, body="""
SELECT iata, label, CAST(delays AS BIGINT) AS delays, minutes, mean_minutes FROM late_total"""))
def q07_late_aircraft_total(spark: SparkSession, sf: str) -> DataFrame:
    totals = _late(spark, sf).groupBy("iata").agg(F.sum("delays").alias("delays"), F.sum("minutes").alias("minutes"))
    named = totals.join(_complete(spark, sf), "iata").select("iata", "label", "delays", "minutes")
    return delays.with_mean(named)


@query("q07_late_aircraft_endpoints", stmt(FLIGHTS, AIRPORTS, ENDS, body="""
SELECT year, iata, count(*) AS delays, sum(CAST(late_aircraft_delay AS DOUBLE)) AS minutes,
  sum(CAST(late_aircraft_delay AS DOUBLE)) / count(*) AS mean_minutes
FROM ends WHERE try_cast(late_aircraft_delay AS DOUBLE) IS NOT NULL GROUP BY year, iata"""))
def q07_late_aircraft_endpoints(spark: SparkSession, sf: str) -> DataFrame:
    return _big(delays.with_mean(delays.late_aircraft_endpoints(src.flight_records(spark, sf))), "year")


@query("q07_top10_per_year", stmt(FLIGHTS, AIRPORTS, LATE, body="""
SELECT year, rank, iata, label, CAST(delays AS BIGINT) AS delays, minutes, minutes / delays AS mean_minutes FROM (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY delays DESC, iata) AS rank FROM late JOIN complete USING (iata))
WHERE rank <= 10"""))
def q07_top10_per_year(spark: SparkSession, sf: str) -> DataFrame:
    named = _late(spark, sf).join(_complete(spark, sf), "iata")
    top = ranking.top_k_per_group(named, "year", 10, F.desc("delays"), F.asc("iata"))
    return delays.with_mean(top.select("year", "rank", "iata", "label", "delays", "minutes"))


@query("q07_top10_overall", stmt(FLIGHTS, AIRPORTS, LATE, body="""
SELECT row_number() OVER (ORDER BY delays DESC, iata) AS rank, iata, label, CAST(delays AS BIGINT) AS delays, minutes, mean_minutes
FROM late_total ORDER BY delays DESC, iata LIMIT 10"""))
def q07_top10_overall(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_k(q07_late_aircraft_total(spark, sf), 10, F.desc("delays"), F.asc("iata"))


@query("q07_worst_mean", stmt(FLIGHTS, AIRPORTS, LATE, body="""
SELECT iata, label, CAST(delays AS BIGINT) AS delays, minutes, mean_minutes FROM late_total
ORDER BY mean_minutes DESC, iata LIMIT 1"""))
def q07_worst_mean(spark: SparkSession, sf: str) -> DataFrame:
    return q07_late_aircraft_total(spark, sf).orderBy(F.desc("mean_minutes"), F.asc("iata")).limit(1)


# ---- report lines -------------------------------------------------------------------------------

def _report(*ctes: str, parts: list[str], fixed: list[tuple[int, int, str]]) -> str:
    """SQL twin of a report: line selects and fixed lines."""
    values = ", ".join(f"(CAST({s} AS BIGINT), CAST({r} AS BIGINT), E'{t}')" for s, r, t in fixed)
    return stmt(*ctes, body="\nUNION ALL ".join([*parts, f"SELECT * FROM (VALUES {values}) AS f(section, rank, line)"]))


def _line(measures: list[tuple[str, str]], code: str = "iata", label: str = "label", number: bool = True) -> str:
    lead = "CAST(rank AS VARCHAR) || ': " if number else "'"
    tail = " || ".join(f"E'\\t{title}:\\t' || CAST({name} AS VARCHAR)" for title, name in measures)
    return f"{lead}(' || {code} || ') ' || coalesce({label}, 'null') || {tail}"


# The titles, headings and measure names below are the wording of the reports.

@query("report_q01_lines", _report(FLIGHTS, TIMES, parts=["""
SELECT CAST(CASE kind WHEN 'HOUR' THEN 1 WHEN 'DAY' THEN 2 ELSE 3 END AS BIGINT) AS section,
  row_number() OVER (PARTITION BY kind ORDER BY mean_delay, grp) AS rank,
  CASE WHEN kind = 'HOUR' THEN 'HOUR ' || grp ELSE grp || E'\t' END || E'\tDELAY:\t' || CAST(mean_delay AS VARCHAR) AS line FROM means"""], fixed=[
    (0, 0, "QUESTION 1: \\tWhat is the best time-of-the-day/day-of-week/time-of-year to fly to minimize delays?"),
    (1, -1, "\\t"), (1, 0, "Time-of-the-day\\t(ordered from best to worst):"),
    (2, -1, "\\t"), (2, 0, "Day-of-week\\t(ordered from best to worst):"),
    (3, -1, "\\t"), (3, 0, "Time-of-year\\t(ordered from best to worst):")]))
def report_q01_lines(spark: SparkSession, sf: str) -> DataFrame:
    return reports.time_report(q01_ranked(spark, sf))


@query("report_q03_lines", _report(FLIGHTS, AIRPORTS, ENDS, """
tops AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY movements DESC, iata) AS rank FROM moves),
years AS (SELECT DISTINCT year FROM tops),
overall AS (SELECT *, row_number() OVER (ORDER BY movements DESC, iata) AS rank FROM totals)""", parts=[
    f"SELECT year AS section, rank, {_line([('Number of Flights', 'movements')])} AS line FROM tops LEFT JOIN continental USING (iata) WHERE rank <= 10",
    "SELECT year, CAST(-1 AS BIGINT), E'\\t' FROM years",
    "SELECT year, CAST(0 AS BIGINT), E'Year: \\t' || CAST(year AS VARCHAR) FROM years",
    f"SELECT CAST(9998 AS BIGINT), rank, {_line([('Number of Flights', 'movements')])} FROM overall WHERE rank <= 10"], fixed=[
    (0, 0, "QUESTION 3: \\tWhat are the major hubs (busiest airports) in continental U.S.? Has there been a change over the 21-year period covered by this dataset?"),
    (9998, -1, "\\t"),
    (9998, 0, "QUESTION 3 (continued): \\tWhat are the major hubs (busiest airports) in continental U.S.? Please list the top 10.")]))
def report_q03_lines(spark: SparkSession, sf: str) -> DataFrame:
    # one pass over the records feeds both parts
    by_year = staged(_movements(spark, sf), "movements")
    continental = _continental(spark, sf)
    top = ranking.top_k_per_group(by_year, "year", 10, F.desc("movements"), F.asc("iata")).join(continental, "iata", "left")
    overall = ranking.top_k(delays.movements_total(by_year, continental), 10, F.desc("movements"), F.asc("iata"))
    return reports.movement_report(top, overall)


@query("report_q04_lines", _report(FLIGHTS, AIRPORTS, ENDS, """
tops AS (SELECT *, row_number() OVER (ORDER BY delays DESC, iata) AS rank FROM weather)""", parts=[
    "SELECT CAST(1 AS BIGINT) AS section, rank, " + _line([
        ("Total Number of Weather Delays", "delays"), ("Total Number of Minutes of Lost to Weather Delays", "minutes")])
    + " AS line FROM tops LEFT JOIN complete USING (iata) WHERE rank <= 10"], fixed=[
    (0, 0, "QUESTION 4: \\tWhich cities experience the most weather related delays? Please list the top 10.")]))
def report_q04_lines(spark: SparkSession, sf: str) -> DataFrame:
    return reports.weather_report(q04_top10_weather(spark, sf))


_CARRIER_MEASURES = [
    ("Total Number of Carrier Delays", "delays"), ("Total Number of Minutes that were Lost to Delays", "minutes"),
    ("Average Number of Minutes that were Lost to Delays", "mean_minutes")]


@query("report_q05_lines", _report(FLIGHTS, CARRIERS, CARRIER_TOTALS, """
tops AS (SELECT *, row_number() OVER (ORDER BY delays DESC, code) AS rank FROM ct LEFT JOIN carriers USING (code)),
worst AS (SELECT * FROM tops ORDER BY mean_minutes DESC, code LIMIT 1)""", parts=[
    f"SELECT CAST(1 AS BIGINT) AS section, rank, {_line(_CARRIER_MEASURES, 'code', 'description')} AS line FROM tops WHERE rank <= 10",
    f"SELECT CAST(2 AS BIGINT), CAST(1 AS BIGINT), {_line(_CARRIER_MEASURES, 'code', 'description', number=False)} FROM worst"], fixed=[
    (0, 0, "QUESTION 5: \\tWhich carriers have the most delays?"), (2, 0, "Which carrier has the highest average delay?\\t")]))
def report_q05_lines(spark: SparkSession, sf: str) -> DataFrame:
    named = staged(q05_carrier_delay(spark, sf), "carrier-delays").join(places.carriers(src.carrier_listings(spark, sf)), "code", "left")
    top = ranking.top_k(named, 10, F.desc("delays"), F.asc("code"))
    return reports.carrier_report(top, named.orderBy(F.desc("mean_minutes"), F.asc("code")).limit(1))


@query("report_q06_lines", _report(FLIGHTS, AIRPORTS, COASTS, """
ct AS (SELECT coast, sum(delays) AS delays, sum(minutes) AS minutes FROM coast GROUP BY coast),
ranked AS (SELECT *, row_number() OVER (PARTITION BY coast ORDER BY delays DESC, iata) AS rank FROM coast JOIN complete USING (iata)),
sides AS (SELECT coalesce(max(delays) FILTER (coast = 'EAST'), 0) AS e, coalesce(max(delays) FILTER (coast = 'WEST'), 0) AS w FROM ct)""", parts=[
    "SELECT CAST(CASE WHEN coast = 'EAST' THEN 2 ELSE 4 END AS BIGINT) AS section, rank, " + _line([
        ("Total Number of Delays", "delays"), ("Total Number of Minutes that were Lost to Delays", "minutes")]) + " AS line FROM ranked",
    """SELECT CASE WHEN coast = 'EAST' THEN 1 ELSE 3 END, 1, upper(coast[1]) || lower(coast[2:])
  || E' Coast Airports:\\tTotal Number of Minutes Lost to Delays: ' || CAST(minutes AS VARCHAR) FROM ct""",
    """SELECT CASE WHEN coast = 'EAST' THEN 1 ELSE 3 END, 2, upper(coast[1]) || lower(coast[2:])
  || E' Coast Airports:\\tTotal Number of Delays: ' || CAST(CAST(delays AS BIGINT) AS VARCHAR) FROM ct""",
    """SELECT 5, 1, CASE WHEN e > w THEN 'East' ELSE 'West' END || E' Coast airports have more Delays.\\tTotal number of delayed flights: '
  || CAST(CAST(CASE WHEN e > w THEN e ELSE w END AS BIGINT) AS VARCHAR) FROM sides"""], fixed=[
    (0, 0, "QUESTION 6: \\tDo East or West coast airports have more delays?"), *((s, -1, "\\t") for s in range(1, 6))]))
def report_q06_lines(spark: SparkSession, sf: str) -> DataFrame:
    by_airport = staged(q06_coast_airports(spark, sf), "coast-airports")
    ranked = ranking.ranked_within(by_airport.join(_complete(spark, sf), "iata"), "coast", F.desc("delays"), F.asc("iata"))
    return reports.coast_report(delays.coast_totals(by_airport), ranked, delays.coast_winner(by_airport))


_LATE_MEASURES = [
    ("Total Number of Late Aircrafts", "delays"), ("Total Number of Minutes that were Lost to Late Aircrafts", "minutes"),
    ("Average Number of Minutes that were Lost to Late Aircrafts", "mean_minutes")]


@query("report_q07_lines", _report(FLIGHTS, AIRPORTS, LATE, """
tops AS (
  SELECT year, iata, label, CAST(delays AS BIGINT) AS delays, minutes, minutes / delays AS mean_minutes,
    row_number() OVER (PARTITION BY year ORDER BY delays DESC, iata) AS rank FROM late JOIN complete USING (iata)),
years AS (SELECT DISTINCT year FROM tops),
overall AS (
  SELECT iata, label, CAST(delays AS BIGINT) AS delays, minutes, mean_minutes, row_number() OVER (ORDER BY delays DESC, iata) AS rank FROM late_total),
worst AS (SELECT * FROM overall ORDER BY mean_minutes DESC, iata LIMIT 1)""", parts=[
    f"SELECT year AS section, rank, {_line(_LATE_MEASURES)} AS line FROM tops WHERE rank <= 10",
    "SELECT year, CAST(-1 AS BIGINT), E'\\t' FROM years",
    "SELECT year, CAST(0 AS BIGINT), E'Year: \\t' || CAST(year AS VARCHAR) FROM years",
    f"SELECT CAST(9998 AS BIGINT), rank, {_line(_LATE_MEASURES)} FROM overall WHERE rank <= 10",
    f"SELECT CAST(9999 AS BIGINT), CAST(1 AS BIGINT), {_line(_LATE_MEASURES, number=False)} FROM worst"], fixed=[
    (0, 0, "QUESTION 7: \\tWhat are the aspects that you can infer from the LateAircraftDelay field?"),
    (0, 1, "QUESTION 7: \\tWhat are the airports with the most delays due to Late Aircrafts? Has there been a change over the 21-year period covered by this dataset?"),
    (9998, -1, "\\t"), (9998, 0, "Which airlines experience the most late aircraft related delays? \\tPlease list the top 10."),
    (9999, -1, "\\t"), (9999, 0, "Which city has the highest average late aircraft delay across all data?\\t")]))
def report_q07_lines(spark: SparkSession, sf: str) -> DataFrame:
    # one pass over the records feeds all three parts
    late = staged(_late(spark, sf).join(_complete(spark, sf), "iata"), "late-aircraft")
    top = ranking.top_k_per_group(late, "year", 10, F.desc("delays"), F.asc("iata"))
    totals = delays.with_mean(late.groupBy("iata", "label").agg(F.sum("delays").alias("delays"), F.sum("minutes").alias("minutes")))
    overall = ranking.top_k(totals, 10, F.desc("delays"), F.asc("iata"))
    worst = totals.orderBy(F.desc("mean_minutes"), F.asc("iata")).limit(1)
    return reports.late_aircraft_report(delays.with_mean(top), overall, worst)


@query("sink_report_text", f"SELECT line, count(*) AS copies FROM ({ORACLES['report_q03_lines']}) GROUP BY line")
def sink_report_text(spark: SparkSession, sf: str) -> DataFrame:
    """A finished report written as text and read back."""
    path = fresh_path(spark, "report")
    csv_files.write_report(report_q03_lines(spark, sf), path)
    return csv_files.read_lines(spark, path).groupBy("line").agg(F.count("*").alias("copies"))


# ---- user code and sketches ---------------------------------------------------------------------

class EndpointMapper:
    """A record's line as (year, airport) pairs, one for each end that is named."""

    def map(self, line):
        fields = line.split(",")
        if fields[YEAR].isdigit():
            for at in (ORIGIN, DEST):
                if len(fields) > at and fields[at]:
                    yield int(fields[YEAR]), fields[at]


YEAR, ORIGIN, DEST = (src.FLIGHT_COLUMNS.index(c) for c in ("year", "origin", "dest"))


class DelayReducer:
    """Number, minutes and mean of the delays of one key."""

    def __init__(self):
        self.code, self.delays, self.minutes = None, 0, 0.0

    def reduce(self, row):
        self.code = row["code"]
        self.delays += 1
        self.minutes += row["lost"]

    def finish(self):
        yield self.code, self.delays, self.minutes, self.minutes / self.delays


class DelayState:
    """The same as a state of two numbers."""

    def zero(self):
        return 0, 0.0

    def update(self, state, rows):
        return state[0] + rows.num_rows, state[1] + pc.sum(rows.column("lost")).as_py()

    def merge(self, left, right):
        return left[0] + right[0], left[1] + right[1]

    def finish(self, state):
        return state[0], state[1], state[1] / state[0]


def _lost_minutes(spark: SparkSession, sf: str) -> DataFrame:
    lost = src.flight_records(spark, sf).select(F.col("unique_carrier").alias("code"), fx.minutes("carrier_delay").alias("lost"))
    return lost.where((F.col("lost") > 0) & (F.col("code") != ""))


@query("usr_map_lines", ORACLES["q03_year_airport_counts"])
def usr_map_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A user's mapper over the lines of the record files."""
    path = fresh_path(spark, "flights-csv")
    csv_files.write_flights(src.flight_records(spark, sf), path)
    pairs = user_code.map_lines(csv_files.read_lines(spark, path), EndpointMapper, "year bigint, iata string")
    return pairs.groupBy("year", "iata").agg(F.count("*").alias("movements"))


@query("usr_reduce_rows", ORACLES["q05_carrier_delay"])
def usr_reduce_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A user's reducer over the delays of each carrier."""
    return user_code.reduce_rows(_lost_minutes(spark, sf), "code", DelayReducer, "code string, delays bigint, minutes double, mean_minutes double")


@query("usr_aggregate_state", ORACLES["q05_carrier_delay"])
def usr_aggregate_state(spark: SparkSession, sf: str) -> DataFrame:
    """A user's aggregate over the delays of each carrier, combined before the shuffle."""
    return user_code.aggregate(_lost_minutes(spark, sf), "code", DelayState(), "delays bigint, minutes double, mean_minutes double")


@query("prof_key_sketch", ORACLES["prof_key_counts"])
def prof_key_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """The key profile from sketches that are kept for each month and united; few airports are counted exactly."""
    kept = staged(delays.key_sketches(src.flight_records(spark, sf)), "key-sketches")
    return _big(delays.profile_of_sketches(kept), "year")
