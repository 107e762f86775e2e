"""Text input of which the bad lines become a table of their own, with reason and place, in the same scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fairtally.functions.text import fields
from fairtally.storage import written

NO_LINE, WRONG_FIELDS, NOT_A_NUMBER, NOT_AN_INTEGER = "no line", "wrong number of fields", "not a number", "not an integer"


@dataclass(frozen=True)
class Checked:
    """``good``: the parsed rows. ``rejected``: (file, block_start, line, value, reason).

    A block is a part of a file that one task reads, from byte ``block_start`` on; ``line`` counts its
    lines from 0. Files of one block have line numbers that way. ``n_read`` is ``n_good`` + ``n_rejected``.
    """

    good: DataFrame
    rejected: DataFrame
    n_read: int
    n_good: int
    n_rejected: int


def point_columns(line: Column, dim: int | None = None) -> tuple[dict[str, Column], Column]:
    """``features`` and ``grp`` of a line of coordinates and a label, and why it is bad (null if it is not)."""
    parts = fields(line, ",")
    count = F.greatest(F.size(parts) - 1, F.lit(0)) if dim is None else F.lit(dim)

    def number(text: Column) -> Column:
        value = text.try_cast("double")
        return F.when(~F.isnan(value), value)

    features = F.transform(F.slice(parts, F.lit(1), count), number)
    whole = F.size(parts) >= 1 if dim is None else F.size(parts) == dim + 1
    reason = (
        F.when(line.isNull(), NO_LINE).when(~whole, WRONG_FIELDS).when(F.exists(features, lambda x: x.isNull()), NOT_A_NUMBER)
    )
    return {"features": features, "grp": F.try_element_at(parts, F.lit(-1))}, reason


def item_columns(line: Column) -> tuple[dict[str, Column], Column]:
    """``item`` of a line, and why it is bad: as ``parse_items``, only a sign and digits that fit a bigint are one."""
    value = F.when(line.rlike(r"^[+-]?[0-9]+\z"), line.try_cast("bigint"))
    return {"item": value}, F.when(line.isNull(), NO_LINE).when(value.isNull(), NOT_AN_INTEGER)


def _checked(spark: SparkSession, path: str | list[str], columns: dict[str, Column], reason: Column) -> Checked:
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start")
    )
    # Rising along the lines of a task, so that its difference within a block is the line's number there.
    tagged = lines.select("*", F.monotonically_increasing_id().alias("mark"), reason.alias("reason"), *[c.alias(n) for n, c in columns.items()])
    bad = F.col("reason").isNotNull()
    watch = Observation("lines")
    counted = tagged.observe(watch, F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"))
    slim = counted.select(
        "file", "block_start", "mark", "reason", F.when(bad, F.col("value")).alias("value"), *[F.when(~bad, F.col(n)).alias(n) for n in columns]
    )
    table = written(slim, "lines")
    seen = watch.get
    blocks = table.groupBy("file", "block_start").agg(F.min("mark").alias("first"))
    places = table.where("reason IS NOT NULL").join(blocks, ["file", "block_start"])
    rejected = places.select("file", "block_start", (F.col("mark") - F.col("first")).alias("line"), "value", "reason")
    good = table.where("reason IS NULL").select(*columns)
    return Checked(good, rejected, seen["n"], seen["n"] - seen["bad"], seen["bad"])


def read_points_checked(spark: SparkSession, path: str | list[str], dim: int | None = None) -> Checked:
    """Points (features, grp) of text files and the lines that are none; the files are read once."""
    return _checked(spark, path, *point_columns(F.col("value"), dim))


def read_items_checked(spark: SparkSession, path: str | list[str]) -> Checked:
    """Items of text files, one integer per line, and the lines that are none; the files are read once."""
    return _checked(spark, path, *item_columns(F.col("value")))
