"""Two-group point sets on which standard k-means is unfair."""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the generator.
DIRECTIONS = ((1, 1), (1, -1), (-1, -1), (-1, 1))
FIRST_CENTER = 1000.0
CENTER_STEP = 25000.0
SPREAD = 5.0
SHIFT_B = 1050.0
SHARE_B = 0.1


def cluster_sizes(n: int, k: int) -> tuple[int, int]:
    """Points of group A and of group B in each cluster; the remainder of n / k is dropped."""
    if n < 0 or k < 1:
        raise ValueError("n must not be negative and k must be positive")
    size = n // k
    b = max(1, int(size * SHARE_B + 0.5))
    return max(size - b, 0), b


def _uniform(text: Column, start: int) -> Column:
    """A number strictly between 0 and 1 from 13 hexadecimal digits (52 bits) of a digest."""
    digits = F.conv(F.substring(F.md5(text), start, 13), 16, 10).cast("double")
    return (digits + 0.5) / F.lit(float(2**52))


def gaussian_noise(seed: int, row_id: Column, axis: int) -> Column:
    """Standard normal noise that depends on nothing but seed, row and axis (Box-Muller)."""
    text = F.concat_ws("|", F.lit(str(seed)), row_id.cast("string"), F.lit(str(axis)))
    radius = F.sqrt(-2 * F.log(_uniform(text, 1)))
    return radius * F.cos(F.lit(2 * math.pi) * _uniform(text, 17))


def synth_points(
    spark: SparkSession,
    n: int,
    k: int,
    seed: int = 1,
    partitions: int | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """(cluster_id, features, grp): k Gaussian blobs of group A, each with a small group B
    further out in the same direction.

    Rows are generated inside the tasks. Every row is a function of the seed and its number, so
    partitioning and repeated tasks change nothing. ``ids`` is a table whose column ``id`` has
    the numbers to use, from 0; numbers beyond the last cluster are left out.
    """
    a, b = cluster_sizes(n, k)
    if k > n:
        warnings.warn("more clusters than points", stacklevel=2)
    if a == 0:
        warnings.warn("clusters too small to hold points of group A", stacklevel=2)
    per = a + b
    if ids is not None:
        rows = ids.where((F.col("id") >= 0) & (F.col("id") < k * per))
    else:
        rows = spark.range(0, k * per, 1, partitions) if partitions else spark.range(k * per)
    placed = rows.select(
        "id",
        F.floor(F.col("id") / F.lit(per)).cast("int").alias("cluster_id"),
        (F.col("id") % F.lit(per) >= a).alias("is_b"),
    )
    reach = F.lit(FIRST_CENTER) + F.col("cluster_id") * F.lit(CENTER_STEP)
    reach = reach + F.when(F.col("is_b"), F.lit(SHIFT_B)).otherwise(F.lit(0.0))

    def coordinate(axis: int) -> Column:
        side = F.get(
            F.array(*[F.lit(float(d[axis])) for d in DIRECTIONS]), F.col("cluster_id") % len(DIRECTIONS)
        )
        return side * reach + gaussian_noise(seed, F.col("id"), axis) * F.lit(SPREAD)

    return placed.select(
        "cluster_id",
        F.array(coordinate(0), coordinate(1)).alias("features"),
        F.when(F.col("is_b"), F.lit("B")).otherwise(F.lit("A")).alias("grp"),
    )
