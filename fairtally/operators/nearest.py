"""Nearest-center assignment."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairtally.functions.batches import BAD_POINT, coordinates, nearest_in_batch
from fairtally.functions.centers import as_centers

# Up to this many (center, coordinate) terms the distances are plain column expressions
# inside whole-stage codegen. With more of them the generated method outgrows what the JIT
# compiles, and Arrow batches with numpy are faster (measured, see README).
UNROLL_MAX_TERMS = 16

# Up to this dimension the coordinates go to Python as plain columns, beyond it as a list.
FLAT_MAX_DIM = 16


def unrolls(centers: np.ndarray) -> bool:
    return centers.size <= UNROLL_MAX_TERMS


def with_nearest(
    points: DataFrame,
    centers: Sequence[Sequence[float]] | np.ndarray,
    features: str = "features",
    cluster_col: str = "cluster_id",
    dist_col: str = "dist",
) -> DataFrame:
    """Add the index of the nearest center and the squared distance to it.

    Ties go to the lowest index. No shuffle and no join: the centers are part of the
    plan, or of the function that Spark ships to the tasks.
    """
    table = as_centers(centers)
    if unrolls(table):
        return _nearest_columns(points, table, features, cluster_col, dist_col)
    return _nearest_arrow(points, table, features, cluster_col, dist_col)


def coordinate_columns(features: str, d: int) -> list[Column]:
    """The d coordinates; the first is null when the point has another dimension."""
    coords = [F.get(features, F.lit(j)).cast("double") for j in range(d)]
    coords[0] = F.when(F.size(features) == d, coords[0])
    return coords


def python_columns(features: str, d: int) -> list[Column]:
    """The points as columns for Arrow batches."""
    return coordinate_columns(features, d) if d <= FLAT_MAX_DIM else [F.col(features).cast("array<double>")]


def _nearest_columns(
    points: DataFrame, centers: np.ndarray, features: str, cluster_col: str, dist_col: str
) -> DataFrame:
    xs = [f"__x{j}" for j in range(centers.shape[1])]

    # Missing coordinates become NaN, so the distances are non-null arithmetic and a bad
    # point shows as a smallest distance that is not finite.
    coords = [F.coalesce(x, F.lit(float("nan"))) for x in coordinate_columns(features, len(xs))]
    frame = points.select("*", *[x.alias(n) for x, n in zip(coords, xs)])

    def candidate(i: int, center: np.ndarray) -> Column:
        total = None
        for name, value in zip(xs, center):
            step = (F.col(name) - F.lit(float(value))) * (F.col(name) - F.lit(float(value)))
            total = step if total is None else total + step
        return F.struct(total.alias("dist"), F.lit(i).alias("id"))

    # The least (distance, index) pair. Every stage reads the one before more than once, so
    # Catalyst keeps them apart and computes each distance once per point.
    pairs = [candidate(i, c) for i, c in enumerate(centers)]
    frame = frame.select(*points.columns, (F.least(*pairs) if len(pairs) > 1 else pairs[0]).alias("__best"))
    dist = F.col("__best.dist")
    fail = F.raise_error(F.lit(BAD_POINT)).cast("double")
    checked = F.when(dist < F.lit(float("inf")), dist).otherwise(fail)
    return _with_result(
        frame, points.columns, F.coalesce("__best.id", F.lit(-1)), F.coalesce(checked, F.lit(-1.0)), cluster_col, dist_col
    )


def _nearest_arrow(
    points: DataFrame, centers: np.ndarray, features: str, cluster_col: str, dist_col: str
) -> DataFrame:
    # Spark moves the pickled function to a broadcast by itself once it exceeds 1 MB.
    @F.arrow_udf("cluster_id int, dist double")
    def nearest(*arrays: pa.Array) -> pa.Array:
        index, dist = nearest_in_batch(coordinates(list(arrays), centers.shape[1]), centers)
        return pa.StructArray.from_arrays([pa.array(index), pa.array(dist)], names=["cluster_id", "dist"])

    frame = points.withColumn("__near", nearest(*python_columns(features, centers.shape[1])))
    return _with_result(
        frame,
        points.columns,
        F.coalesce("__near.cluster_id", F.lit(-1)),
        F.coalesce("__near.dist", F.lit(-1.0)),
        cluster_col,
        dist_col,
    )


def _with_result(
    frame: DataFrame, keep: list[str], index: Column, dist: Column, cluster_col: str, dist_col: str
) -> DataFrame:
    # A generator of one row. Filters on the result, also those that joins infer, stay above
    # it; pushed below, they would compute all distances a second time.
    found = F.struct(index.alias(cluster_col), dist.alias(dist_col))
    return frame.select(*keep, F.inline(F.array(found)))
