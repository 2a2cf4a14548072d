"""Scalar rules for text fields of the delay records.

A field is missing when it is empty, ``NA``, null or not a number (a header token, say).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names in calendar order, one-based.
DAY_NAMES = ["MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY"]
MONTH_NAMES = [
    "JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE",
    "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER",
]

# Airports counted as East and West coast.
EAST_COAST = [
    "IAD", "DCA", "ATL", "BWI", "BOS", "CLT", "CAE", "JAX", "MIA",
    "JFK", "LGA", "EWR", "PHL", "PIT", "RDU", "RIC", "TPA",
]
WEST_COAST = [
    "ABQ", "LAS", "LAX", "OAK", "PHX", "PDX", "RNO",
    "MHR", "SLC", "SAN", "SFO", "SJC", "BFI", "SEA",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes(c: Column | str) -> Column:
    """Delay minutes, null when missing; zero and negative values are kept.

    The usual missing tokens are sorted out by comparison, because a failed cast of text to a
    number costs far more than a successful one.
    """
    raw = _col(c)
    return F.when((raw != "NA") & (raw != ""), raw.try_cast("double"))


def minutes_or_zero(c: Column | str) -> Column:
    """Delay minutes with a missing value counted as no delay."""
    return F.coalesce(minutes(c), F.lit(0.0))


def present(c: Column | str) -> Column:
    return F.coalesce(F.length(_col(c)), F.lit(0)) > 0


def hour_of(c: Column | str) -> Column:
    """Hour of an ``HHmm`` time written without leading zeros; null unless it is a valid time."""
    raw = _col(c)
    digit_ends = F.left(raw, F.lit(1)).between("0", "9") & F.right(raw, F.lit(1)).between("0", "9")
    number = F.when((F.length(raw) <= 4) & digit_ends, raw.try_cast("int"))
    return F.when((number < 2400) & (number % 100 < 60), (number / 100).cast("int"))


def whole_within(c: Column | str, last: int) -> Column:
    """The whole number 1..``last`` in a text field; null when out of range."""
    number = _col(c).try_cast("int")
    return F.when(number.between(1, last), number)


def name_at(number: Column, names: list[str]) -> Column:
    """Name of a number from 1; null for null."""
    return F.get(F.array(*[F.lit(n) for n in names]), number - 1)


def day_name(c: Column | str) -> Column:
    """Weekday name of 1..7 (1 is Monday); null when out of range."""
    return name_at(whole_within(c, len(DAY_NAMES)), DAY_NAMES)


def month_name(c: Column | str) -> Column:
    """Month name of 1..12; null when out of range."""
    return name_at(whole_within(c, len(MONTH_NAMES)), MONTH_NAMES)


def coast_of(c: Column | str) -> Column:
    """``EAST``, ``WEST`` or null for an airport code."""
    code = _col(c)
    return F.when(code.isin(EAST_COAST), "EAST").when(code.isin(WEST_COAST), "WEST")


def airport_label(airport: Column | str, city: Column | str, state: Column | str) -> Column:
    return F.concat(_col(airport), F.lit(", located in "), _col(city), F.lit(", "), _col(state))


def is_continental(airport: Column | str, city: Column | str, state: Column | str) -> Column:
    """Two-letter state other than Hawaii and Alaska, with airport and city filled in."""
    return (F.length(_col(state)) == 2) & ~_col(state).isin("HI", "AK") & present(airport) & present(city)


def all_present(*cols: Column | str) -> Column:
    condition = present(cols[0])
    for c in cols[1:]:
        condition = condition & present(c)
    return condition


def payload_value(payload: Column | str, key: str) -> Column:
    """The value of ``key`` in a ``K:V,K:V`` payload.

    A part counts only when it is exactly one key and one value; the last such part wins.
    """
    found = F.regexp_extract(_col(payload), f"^(?:.*,)?{key}:([^:,]+)(?:,.*)?$", 1)
    return F.nullif(found, F.lit(""))


def hex_to_int(c: Column | str) -> Column:
    return F.conv(_col(c), 16, 10).cast("bigint")
