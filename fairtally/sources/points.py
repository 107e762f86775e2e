"""Labelled points as text: coordinates and a group label, separated by commas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from fairtally.functions.text import fields

MODES = ("FAILFAST", "DROPMALFORMED")


def read_lines(
    spark: SparkSession, path: str | list[str], partitions: int | None = None, cache: bool = False
) -> DataFrame:
    """One row per line in ``value``.

    ``partitions`` spreads the lines over that many random partitions; leave it out and the
    file splits decide.
    """
    lines = spark.read.text(path)
    if partitions is not None:
        lines = lines.repartition(partitions)
    return lines.persist(StorageLevel.MEMORY_AND_DISK) if cache else lines


def parse_points(lines: DataFrame, dim: int | None = None, mode: str = "FAILFAST", column: str = "value") -> DataFrame:
    """Replace the text column by ``features array<double>`` and ``grp string``.

    The last field is the label, all others are coordinates. A known ``dim`` keeps the
    parsing in generated code. FAILFAST raises on a bad line, DROPMALFORMED leaves it out;
    a coordinate must be a number other than NaN. A blank line is a point of dimension 0.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    kept = [c for c in lines.columns if c != column]
    parts = lines.select(*kept, F.col(column).alias("__line"), fields(F.col(column), ",").alias("__parts"))
    if dim is None:
        count = F.greatest(F.size("__parts") - 1, F.lit(0))
        features = F.transform(F.slice("__parts", F.lit(1), count), _coordinate)
    else:
        numbers = [F.get("__parts", F.lit(j)).try_cast("double").alias(f"__c{j}") for j in range(dim)]
        parts = parts.select("*", *numbers)
        features = F.array(*[_number(F.col(f"__c{j}")) for j in range(dim)])
    label = F.try_element_at("__parts", F.lit(-1))
    parsed = parts.select(*kept, "__line", F.size("__parts").alias("__n"), features.alias("features"), label.alias("grp"))
    if dim is None:
        bad = (F.col("__n") < 1) | F.exists("features", lambda x: x.isNull())
    else:
        bad = F.col("__n") != dim + 1
        for j in range(dim):
            bad = bad | F.get("features", F.lit(j)).isNull()
    bad = F.coalesce(bad, F.lit(True))
    if mode == "DROPMALFORMED":
        return parsed.where(~bad).select(*kept, "features", "grp")
    fail = F.raise_error(F.concat(F.lit("malformed point: "), F.coalesce("__line", F.lit("null"))))
    checked = F.when(bad, fail.cast("array<double>")).otherwise(F.col("features"))
    return parsed.select(*kept, checked.alias("features"), "grp")


def _number(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def _coordinate(text: Column) -> Column:
    return _number(text.try_cast("double"))


def read_points(
    spark: SparkSession,
    path: str | list[str],
    dim: int | None = None,
    mode: str = "FAILFAST",
    partitions: int | None = None,
) -> DataFrame:
    """Points of one or more text files: ``features array<double>, grp string``."""
    return parse_points(read_lines(spark, path, partitions), dim, mode)


def format_points(points: DataFrame, features: str = "features", grp: str = "grp", keep: list[str] | None = None) -> DataFrame:
    """One text line per point, all coordinates with three decimals, the label last; ``keep`` names columns to keep beside.

    A missing point, coordinate or label raises: its line would be read back as another point.
    """
    x = F.col(features)
    whole = x.isNotNull() & F.col(grp).isNotNull() & ~F.exists(x, lambda v: v.isNull())
    text = F.concat_ws(",", F.transform(x, lambda v: F.format_string("%.3f", v)), F.col(grp))
    fail = F.raise_error(F.lit("point with a missing coordinate or label")).cast("string")
    return points.select(*(keep or []), F.when(F.coalesce(whole, F.lit(False)), text).otherwise(fail).alias("value"))


def write_points(
    points: DataFrame, path: str, mode: str = "errorifexists", features: str = "features", grp: str = "grp"
) -> None:
    format_points(points, features, grp).write.mode(mode).text(path)
