"""Streams of items, one integer per text line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_items(lines: DataFrame, column: str = "value") -> DataFrame:
    """(item bigint) of a batch or streaming DataFrame of lines.

    Only an optional sign and digits are a number; blanks around them are not accepted.
    """
    text = F.col(column)
    value = F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast("bigint"))
    fail = F.raise_error(F.concat(F.lit("not an integer: "), F.coalesce(text, F.lit("null"))))
    return lines.select(F.coalesce(value, fail.cast("bigint")).alias("item"))


def socket_items(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Items from a text socket. Spark cannot replay a socket: for trying things out only."""
    lines = spark.readStream.format("socket").option("host", host).option("port", port).load()
    return parse_items(lines)


def file_items(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Items from text files that appear in a folder; replayable after a failure."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_items(reader.text(path))
