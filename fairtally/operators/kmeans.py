"""Standard k-means: a k-means|| start and Lloyd rounds, one scan each."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairtally.functions.centers import as_centers
from fairtally.operators.nearest import with_nearest
from fairtally.operators.start import start_centers
from fairtally.storage import held


def lloyd_round(points: DataFrame, centers: np.ndarray, features: str = "features") -> np.ndarray:
    """The mean of each center's points; a center without points stays."""
    near = with_nearest(points.select(features), centers, features)
    vector = array_to_vector(F.col(features).cast("array<double>"))
    moved = as_centers(centers).copy()
    # At most k rows.
    for row in near.groupBy("cluster_id").agg(Summarizer.mean(vector).alias("m")).collect():
        moved[row["cluster_id"]] = row["m"].toArray()
    return moved


def kmeans(
    points: DataFrame,
    k: int,
    max_iter: int,
    seed: int = 1,
    features: str = "features",
    tol: float = 1e-4,
    init: Sequence[Sequence[float]] | np.ndarray | None = None,
    ids: Sequence[str] | None = None,
    cache: bool = True,
) -> np.ndarray:
    """Centers after at most ``max_iter`` Lloyd rounds from a k-means|| start, or from ``init``.

    There may be fewer than ``k`` centers when the points have few distinct values. Rounds end
    early when no center moves by more than ``tol``. ``ids`` helps the start, see ``start_centers``.
    ``cache`` keeps the needed columns in memory and on disk over the start and the rounds.
    """
    if k < 1 or max_iter < 0:
        raise ValueError("k must be positive and max_iter not negative")
    needed = points.select(*(ids or []), features)
    with held(needed, cache and not (init is not None and max_iter < 2)) as rows:
        centers = as_centers(init) if init is not None else start_centers(rows, k, seed, features, ids)
        for _ in range(max_iter):
            before, centers = centers, lloyd_round(rows, centers, features)
            if (((centers - before) ** 2).sum(axis=1) <= tol**2).all():
                break
        return centers


def initial_centers(
    points: DataFrame, k: int, seed: int = 1, features: str = "features", ids: Sequence[str] | None = None
) -> np.ndarray:
    """k-means|| start centers without any Lloyd round."""
    return kmeans(points, k, 0, seed, features, ids=ids)
