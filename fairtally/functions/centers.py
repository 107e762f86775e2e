"""Centers: a K x d table that the driver holds, because K is small."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def as_centers(centers: Sequence[Sequence[float]] | np.ndarray) -> np.ndarray:
    """Checked float64 matrix, one row per center."""
    table = np.array(centers, dtype=np.float64)
    if table.ndim != 2 or table.shape[0] < 1 or table.shape[1] < 1:
        raise ValueError("centers must be a non-empty list of points of one dimension")
    if not np.isfinite(table).all():
        raise ValueError("centers must be finite")
    return table


def centers_frame(spark: SparkSession, centers: Sequence[Sequence[float]] | np.ndarray) -> DataFrame:
    """(cluster_id int, center array<double>), one row per center."""
    table = as_centers(centers)
    rows = pa.table(
        {"cluster_id": pa.array(range(len(table)), pa.int32()), "center": pa.array(list(table), pa.list_(pa.float64()))}
    )
    return spark.createDataFrame(rows)
