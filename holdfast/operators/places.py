"""Airport and carrier dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions import fields as fx


def last_wins(listings: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key: the value loaded last. Reduces map-side, so a hot key is harmless."""
    return listings.groupBy(key).agg(F.max_by(value, order).alias(value), F.max(order).alias(order))


def continental(airports: DataFrame) -> DataFrame:
    """Labelled airports of the continental states."""
    return airports.where(fx.is_continental("airport", "city", "state")).select(
        "iata", fx.airport_label("airport", "city", "state").alias("label")
    )


def complete(airports: DataFrame) -> DataFrame:
    """Labelled airports with every field filled in."""
    return airports.where(fx.all_present("iata", "airport", "city", "state")).select(
        "iata", fx.airport_label("airport", "city", "state").alias("label")
    )


def carriers(listings: DataFrame) -> DataFrame:
    """Carrier names: complete rows only, the last one loaded wins."""
    filled = listings.where(fx.all_present("code", "description"))
    return last_wins(filled, "code", "description", "load_order").select("code", "description")
