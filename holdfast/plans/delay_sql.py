"""SQL twins of the delay queries. Written apart from the DataFrame code on purpose."""

from __future__ import annotations

# Airport codes of the test rows with their states, and the coast lists.
_CODES = (
    "['IAD','DCA','ATL','BWI','BOS','JFK','EWR','MIA','LAX','SFO','SEA','PHX','LAS',"
    "'SLC','SAN','ORD','DFW','DEN','IAH','MSP','DTW','ANC','HNL','SJU','ZZZ']"
)
_STATES = (
    "['VA','VA','GA','MD','MA','NY','NJ','FL','CA','CA','WA','AZ','NV',"
    "'UT','CA','IL','TX','CO','TX','MN','MI','AK','HI','PR','']"
)
_EAST = "('IAD','DCA','ATL','BWI','BOS','CLT','CAE','JAX','MIA','JFK','LGA','EWR','PHL','PIT','RDU','RIC','TPA')"
_WEST = "('ABQ','LAS','LAX','OAK','PHX','PDX','RNO','MHR','SLC','SAN','SFO','SJC','BFI','SEA')"

FLIGHTS = f"""
flights AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CAST(year(l_shipdate) AS VARCHAR) AS year,
    CAST(month(l_shipdate) AS VARCHAR) AS month,
    CAST(day(l_shipdate) AS VARCHAR) AS day_of_month,
    CAST(isodow(l_shipdate) AS VARCHAR) AS day_of_week,
    CAST(((l_orderkey*7 + l_linenumber*13) % 24)*100 + (l_partkey % 64) AS VARCHAR) AS crs_dep_time,
    'C' || CAST(l_suppkey % 12 AS VARCHAR) AS unique_carrier,
    CASE WHEN l_linenumber = 7 THEN 'NA' ELSE CAST(CAST(l_quantity AS INT) - 20 AS VARCHAR) END AS arr_delay,
    CASE WHEN l_linenumber = 7 OR l_returnflag = 'R' THEN 'NA'
         ELSE CAST(CAST(l_quantity AS INT) - 22 AS VARCHAR) END AS dep_delay,
    CASE WHEN l_orderkey % 41 = 0 THEN '' WHEN CAST(l_quantity AS INT) % 3 = 0 THEN 'ATL'
         ELSE {_CODES}[(l_suppkey % 25) + 1] END AS origin,
    CASE WHEN l_orderkey % 37 = 0 THEN '' ELSE {_CODES}[(l_partkey % 25) + 1] END AS dest,
    CASE WHEN year(l_shipdate) < 1998 THEN 'NA'
         ELSE CAST(greatest(CAST(l_quantity AS INT) - 30, 0) AS VARCHAR) END AS carrier_delay,
    CASE WHEN year(l_shipdate) < 1998 THEN 'NA'
         ELSE CAST(greatest(CAST(l_quantity AS INT) - 42, 0) AS VARCHAR) END AS weather_delay,
    CASE WHEN year(l_shipdate) < 1998 THEN 'NA' WHEN l_linenumber > 3 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR)
         ELSE '0' END AS late_aircraft_delay
  FROM lineitem)"""

AIRPORTS = f"""
airports AS (
  SELECT CASE WHEN n_nationkey = 24 THEN 'XNA' ELSE {_CODES}[n_nationkey + 1] END AS iata,
    n_name || CASE WHEN n_nationkey = 2 THEN ' Hartsfield, Main' ELSE ' Field' END AS airport,
    CASE WHEN n_nationkey = 19 THEN '' ELSE n_name END AS city,
    {_STATES}[n_nationkey + 1] AS state
  FROM nation),
continental AS (
  SELECT iata, airport || ', located in ' || city || ', ' || state AS label FROM airports
  WHERE length(state) = 2 AND state NOT IN ('HI','AK') AND airport <> '' AND city <> ''),
complete AS (
  SELECT iata, airport || ', located in ' || city || ', ' || state AS label FROM airports
  WHERE iata <> '' AND airport <> '' AND city <> '' AND state <> '')"""

LISTINGS = f"""
listings AS (
  SELECT c_custkey AS load_order,
    CASE WHEN c_custkey % 53 = 0 THEN '' ELSE {_CODES}[(c_custkey % 25) + 1] END AS iata,
    CASE WHEN c_custkey % 7 = 0 THEN c_name || ', "Main" Field' WHEN c_custkey % 29 = 0 THEN '' ELSE c_name END AS airport,
    CASE WHEN c_custkey % 19 = 0 THEN '' ELSE upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) END AS city,
    CASE WHEN c_custkey % 23 = 0 THEN 'NewYork' ELSE {_STATES}[(c_custkey % 25) + 1] END AS state
  FROM customer)"""

CARRIERS = """
carriers AS (
  SELECT 'C' || CAST(s_suppkey % 12 AS VARCHAR) AS code, arg_max(s_name, s_suppkey) AS description
  FROM supplier WHERE s_suppkey % 12 <> 11 GROUP BY 1)"""

TIMES = """
delayed AS (
  SELECT coalesce(try_cast(arr_delay AS DOUBLE), 0) + coalesce(try_cast(dep_delay AS DOUBLE), 0) AS delay,
    CASE WHEN CAST(crs_dep_time AS INT) % 100 < 60 THEN CAST(CAST(crs_dep_time AS INT) // 100 AS VARCHAR) END AS hour,
    upper(dayname(DATE '2024-01-01' + CAST(CAST(day_of_week AS INT) - 1 AS INT))) AS day,
    upper(monthname(make_date(2024, CAST(month AS INT), 1))) AS mon
  FROM flights),
means AS (
  SELECT kind, grp, sum(delay) AS total_delay, count(*) AS flights, sum(delay) / count(*) AS mean_delay
  FROM (SELECT 'HOUR' AS kind, hour AS grp, delay FROM delayed
        UNION ALL SELECT 'DAY', day, delay FROM delayed
        UNION ALL SELECT 'MONTH', mon, delay FROM delayed)
  WHERE grp IS NOT NULL GROUP BY kind, grp)"""

ENDS = """
ends AS (
  SELECT CAST(year AS BIGINT) AS year, iata, weather_delay, late_aircraft_delay
  FROM (SELECT *, origin AS iata FROM flights UNION ALL SELECT *, dest AS iata FROM flights)
  WHERE iata <> ''),
moves AS (SELECT year, iata, count(*) AS movements FROM ends GROUP BY year, iata),
totals AS (SELECT iata, label, sum(movements) AS movements FROM moves JOIN continental USING (iata) GROUP BY iata, label),
weather AS (
  SELECT iata, count(*) AS delays, sum(CAST(weather_delay AS DOUBLE)) AS minutes FROM ends
  WHERE try_cast(weather_delay AS DOUBLE) > 0 GROUP BY iata)"""

CARRIER_TOTALS = """
ct AS (
  SELECT unique_carrier AS code, count(*) AS delays, sum(CAST(carrier_delay AS DOUBLE)) AS minutes,
    sum(CAST(carrier_delay AS DOUBLE)) / count(*) AS mean_minutes
  FROM flights WHERE try_cast(carrier_delay AS DOUBLE) > 0 GROUP BY 1)"""

COASTS = f"""
coast AS (
  SELECT CASE WHEN iata IN {_EAST} THEN 'EAST' ELSE 'WEST' END AS coast, iata, count(*) AS delays, sum(d) AS minutes
  FROM (SELECT dest AS iata, try_cast(arr_delay AS DOUBLE) AS d FROM flights
        UNION ALL SELECT origin, try_cast(dep_delay AS DOUBLE) FROM flights)
  WHERE d > 0 AND (iata IN {_EAST} OR iata IN {_WEST}) GROUP BY 1, 2)"""

LATE = """
late AS (
  SELECT CAST(year AS BIGINT) AS year, origin AS iata,
    sum(CASE WHEN dest <> '' THEN 2 ELSE 1 END) AS delays,
    sum(CASE WHEN dest <> '' THEN 2 ELSE 1 END * CAST(late_aircraft_delay AS DOUBLE)) AS minutes
  FROM flights WHERE try_cast(late_aircraft_delay AS DOUBLE) IS NOT NULL AND origin <> '' GROUP BY 1, 2),
late_total AS (
  SELECT iata, label, sum(delays) AS delays, sum(minutes) AS minutes, sum(minutes) / sum(delays) AS mean_minutes
  FROM late JOIN complete USING (iata) GROUP BY iata, label)"""


def stmt(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body
