"""Text sources and sinks of the delay jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.sources.tables import FLIGHT_COLUMNS

FLIGHT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in FLIGHT_COLUMNS])


def read_flights(spark: SparkSession, path: str) -> DataFrame:
    """On-time CSV by position: commas always split, short lines get nulls, empty lines vanish.

    A header is told by its year, which is no number, so files with and without one are read alike.
    """
    return (
        spark.read.schema(FLIGHT_SCHEMA)
        .option("header", False)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", True)
        .csv(path)
        .where(F.col("year").try_cast("int").isNotNull())
    )


def read_dimension(spark: SparkSession, path: str, columns: list[str], header: bool = False) -> DataFrame:
    """Lookup CSV: commas inside quotes belong to the field and the outer quotes are dropped."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
        .na.fill("")
    )


def write_dimension(df: DataFrame, path: str) -> None:
    df.write.option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)


def write_flights(df: DataFrame, path: str, header: bool = True) -> None:
    df.select(*FLIGHT_COLUMNS).write.option("header", header).option("emptyValue", "").csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.length("value") > 0).withColumnRenamed("value", "line")


def field_count(line: Column | str) -> Column:
    """Number of comma-split fields, trailing empty ones not counted."""
    c = F.col(line) if isinstance(line, str) else line
    return F.size(F.split(F.regexp_replace(c, ",+$", ""), ",")).cast("bigint")


def write_report(lines: DataFrame, path: str) -> None:
    """Write a finished report as text, in report order.

    A report is one line per ranked entry, so it is small; the sort makes part files follow
    each other in order without forcing a single task.
    """
    lines.orderBy("section", "rank").select("line").write.text(path)
