"""Edge cases of delay records: missing spellings, bad times, short lines, headers, ties."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from holdfast.functions import fields as fx
from holdfast.operators import delays, places, ranking, reports
from holdfast.sources import csv_files
from holdfast.sources.tables import FLIGHT_COLUMNS


def flights(spark, *rows: dict):
    data = [tuple(r.get(c, "") for c in FLIGHT_COLUMNS) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in FLIGHT_COLUMNS))


def column(spark, values, expr):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "c string").select(expr).collect()]


def test_missing_spellings(spark):
    values = ["5", "-3", "0", "NA", "", None, "ArrDelay"]
    assert column(spark, values, fx.minutes("c")) == [5.0, -3.0, 0.0, None, None, None, None]
    assert column(spark, values, fx.minutes_or_zero("c")) == [5.0, -3.0, 0.0, 0.0, 0.0, 0.0, 0.0]


@pytest.mark.parametrize("text, hour", [
    ("5", 0), ("905", 9), ("0", 0), ("2359", 23), ("1230", 12), ("2400", None), ("0975", None),
    ("12345", None), ("", None), ("NA", None), (None, None), ("-5", None), ("CRSDepTime", None),
])
def test_hour_of(spark, text, hour):
    assert column(spark, [text], fx.hour_of("c")) == [hour]


def test_names_out_of_range(spark):
    assert column(spark, ["0", "1", "7", "8", "NA"], fx.day_name("c")) == [None, "MONDAY", "SUNDAY", None, None]
    assert column(spark, ["0", "1", "12", "13"], fx.month_name("c")) == [None, "JANUARY", "DECEMBER", None]


def test_payload_parts(spark):
    rows = ["A:1,B:2", "A:1:2,B:2", "A:", "junk,A:7", "A:1,A:3", "XA:4", "", None]
    assert column(spark, rows, fx.payload_value("c", "A")) == ["1", None, None, "7", "3", None, None, None]


def test_coasts(spark):
    assert column(spark, ["ATL", "SEA", "ORD", "", None], fx.coast_of("c")) == ["EAST", "WEST", None, None, None]


def test_bad_time_still_counts_for_day_and_month(spark):
    rows = flights(spark, {"crs_dep_time": "2400", "day_of_week": "1", "month": "2", "arr_delay": "10", "dep_delay": "NA"},
                   {"crs_dep_time": "905", "day_of_week": "9", "month": "2", "arr_delay": "NA", "dep_delay": ""})
    got = {(r.kind, r.grp): (r.flights, r.mean_delay) for r in delays.mean_delay_by_time(rows).collect()}
    assert got == {("HOUR", "9"): (1, 0.0), ("DAY", "MONDAY"): (1, 10.0), ("MONTH", "FEBRUARY"): (2, 5.0)}


def test_movements_skip_empty_ends_and_headers(spark):
    rows = flights(spark, {"year": "2001", "origin": "ATL", "dest": "SEA"}, {"year": "2001", "origin": "", "dest": "ATL"},
                   {"year": "Year", "origin": "Origin", "dest": "Dest"})
    got = {(r.year, r.iata): r.movements for r in delays.movements_by_year(rows).collect()}
    assert got == {(2001, "ATL"): 2, (2001, "SEA"): 1}


def test_coast_counts_both_ends_of_a_flight(spark):
    rows = flights(spark, {"origin": "ATL", "dest": "BOS", "arr_delay": "3", "dep_delay": "4"},
                   {"origin": "SEA", "dest": "ORD", "arr_delay": "9", "dep_delay": "0"})
    by_airport = delays.coast_delays(rows)
    assert {r.iata: (r.coast, r.delays, r.minutes) for r in by_airport.collect()} == {
        "BOS": ("EAST", 1, 3.0), "ATL": ("EAST", 1, 4.0)}
    assert delays.coast_winner(by_airport).first() == ("East", 2)


def test_coast_tie_goes_west(spark):
    rows = flights(spark, {"origin": "SEA", "dest": "ATL", "arr_delay": "1", "dep_delay": "1"})
    assert delays.coast_winner(delays.coast_delays(rows)).first() == ("West", 1)


def test_late_aircraft_is_counted_twice_at_the_origin(spark):
    rows = flights(spark, {"year": "2000", "origin": "ATL", "dest": "SEA", "late_aircraft_delay": "5"},
                   {"year": "2000", "origin": "ATL", "dest": "", "late_aircraft_delay": "0"},
                   {"year": "2000", "origin": "", "dest": "SEA", "late_aircraft_delay": "7"},
                   {"year": "2000", "origin": "ATL", "dest": "SEA", "late_aircraft_delay": "NA"})
    assert {r.iata: (r.delays, r.minutes) for r in delays.late_aircraft_by_year(rows).collect()} == {"ATL": (3, 10.0)}
    each = {r.iata: (r.delays, r.minutes) for r in delays.late_aircraft_endpoints(rows).collect()}
    assert each == {"ATL": (2, 5.0), "SEA": (2, 12.0)}


def test_carrier_delays_drop_empty_codes(spark):
    rows = flights(spark, {"unique_carrier": "", "carrier_delay": "5"}, {"unique_carrier": "C1", "carrier_delay": "4"},
                   {"unique_carrier": "C1", "carrier_delay": "0"}, {"unique_carrier": "C1", "carrier_delay": "3"})
    assert delays.carrier_delays(rows).collect() == [("C1", 2, 7.0, 3.5)]


def test_continental_keeps_territories_and_na(spark):
    rows = spark.createDataFrame(
        [("A", "a", "c", "PR"), ("B", "b", "c", "NA"), ("C", "c", "c", "HI"), ("D", "d", "c", "AK"), ("E", "", "c", "NY"),
         ("F", "f", "", "NY"), ("G", "g", "c", "NYC")], "iata string, airport string, city string, state string")
    assert {r.iata: r.label for r in places.continental(rows).collect()} == {
        "A": "a, located in c, PR", "B": "b, located in c, NA"}
    assert {r.iata for r in places.complete(rows).collect()} == {"A", "B", "C", "D", "G"}


def test_last_listing_wins(spark):
    rows = spark.createDataFrame([("X", "old", 1), ("X", "new", 3), ("X", "mid", 2)], "code string, description string, load_order int")
    assert places.carriers(rows).collect() == [("X", "new")]


def test_ties_are_ranked_by_code(spark):
    rows = spark.createDataFrame([(1, "B", 5), (1, "A", 5), (1, "C", 9), (2, "Z", 1)], "year int, iata string, n int")
    order = F.desc("n"), F.asc("iata")
    assert [(r.iata, r["rank"]) for r in ranking.top_k(rows, 3, *order).orderBy("rank").collect()] == [("C", 1), ("A", 2), ("B", 3)]
    per_year = ranking.top_k_per_group(rows, "year", 2, *order).collect()
    assert {(r.year, r["rank"], r.iata) for r in per_year} == {(1, 1, "C"), (1, 2, "A"), (2, 1, "Z")}


def test_flight_csv_header_short_and_empty_lines(spark, tmp_path):
    path = tmp_path / "flights"
    path.mkdir()
    line = ["1999", "1", "2", "3", "", "905"] + [""] * 8 + ["NA", "4", "ATL", "SEA"]
    (path / "a.csv").write_text("\n".join([",".join(FLIGHT_COLUMNS), ",".join(line), "", '2000,"1', ""]))
    rows = csv_files.read_flights(spark, str(path)).orderBy("year").collect()
    assert [r.year for r in rows] == ["1999", "2000"]
    assert (rows[0].origin, rows[0].arr_delay, rows[0].weather_delay) == ("ATL", "NA", None)
    assert rows[1].month == '"1'


def test_headerless_file_keeps_its_first_line(spark, tmp_path):
    path = tmp_path / "flights"
    path.mkdir()
    (path / "a.csv").write_text("1999,1,2,3\n2000,1,2,3\n")
    assert csv_files.read_flights(spark, str(path)).count() == 2


def test_header_row_never_counts_even_when_read_as_data(spark, tmp_path):
    path = tmp_path / "flights"
    path.mkdir()
    (path / "a.csv").write_text(",".join(FLIGHT_COLUMNS) + "\n")
    rows = csv_files.read_flights(spark, str(path))
    assert delays.movements_by_year(rows).count() == 0
    assert delays.mean_delay_by_time(rows).count() == 0
    assert delays.weather_delays(rows).count() == 0


def test_dimension_csv_quotes(spark, tmp_path):
    path = tmp_path / "dim.csv"
    path.write_text('"00M","Field, North","Bay ""X""","MS"\n"01G",Plain,,"NY"\n')
    rows = csv_files.read_dimension(spark, str(path), ["iata", "airport", "city", "state"]).orderBy("iata").collect()
    assert [tuple(r) for r in rows] == [("00M", "Field, North", 'Bay "X"', "MS"), ("01G", "Plain", "", "NY")]


def test_field_count_ignores_trailing_empties(spark):
    assert column(spark, ["a,b,,", "a", ",,a", ""], csv_files.field_count("c")) == [2, 1, 3, 1]


def test_report_is_written_in_order(spark, tmp_path):
    per_year = spark.createDataFrame([(2001, 1, "ATL", None, 7), (2001, 2, "SEA", "Sea Field", 3)],
                                     "year bigint, rank bigint, iata string, label string, movements bigint")
    lines = reports.movement_report(per_year, per_year.drop("year"))
    csv_files.write_report(lines, str(tmp_path / "report"))
    text = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    in_order = [r.line for r in lines.orderBy("section", "rank").collect()]
    assert sorted(text) == sorted(in_order)
    assert in_order[1:4] == ["\t", "Year: \t2001", "1: (ATL) null\tNumber of Flights:\t7"]
