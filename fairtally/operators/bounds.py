"""Lloyd rounds that skip most distances, by bounds that every point carries from round to round.

``upper`` is at least the distance to a point's own center, ``lower`` at most that to any other. When the
centers move, both follow by how far they moved. A point whose upper bound stays below the lower one, or
below half the way from its center to the next, keeps its center unseen. For others only centers
within twice the upper bound of their own are looked at, from a list ordered by mutual distance.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairtally.functions.batches import BAD_POINT, coordinates
from fairtally.functions.centers import as_centers
from fairtally.storage import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Neighbours that are listed for each center; a point that may reach further sees all centers.
NEIGHBOURS = 256
#: Bounds are sums of rounded numbers: they count as this much wider.
SLACK = 1e-9
STATE = "cluster_id int, upper double, lower double, computed bigint"


@dataclass(frozen=True)
class Neighbourhood:
    """Per center its nearest others: their indices and distances, ascending."""

    centers: np.ndarray
    order: np.ndarray
    dist: np.ndarray

    @staticmethod
    def of(centers: np.ndarray, most: int = NEIGHBOURS) -> Neighbourhood:
        k = len(centers)
        n = min(most, k - 1)
        order, dist = np.zeros((k, n), np.int32), np.zeros((k, n))
        for i, c in enumerate(centers):
            apart = np.sqrt(((centers - c) ** 2).sum(axis=1))
            apart[i] = -1.0
            near = np.argsort(apart, kind="stable")[1 : n + 1]
            order[i], dist[i] = near, apart[near]
        return Neighbourhood(centers, order, dist)


def exact(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances (points x centers), summed coordinate by coordinate as everywhere else."""
    total = np.zeros((x.shape[1], len(centers)))
    for column, value in zip(x, centers.T):
        total += (column[:, None] - value[None, :]) ** 2
    return total


def _two_least(dist: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per point: the nearest of ``ids`` (the lowest among equals), its distance, and the second distance."""
    by_id = np.argsort(ids, kind="stable")
    dist, ids = dist[:, by_id], ids[by_id]
    at = dist.argmin(axis=1)
    rows = np.arange(len(dist))
    least = dist[rows, at]
    rest = dist.copy()
    rest[rows, at] = np.inf
    return ids[at], np.sqrt(least), np.sqrt(rest.min(axis=1))


def first_bounds(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, ...]:
    """(center, upper, lower, distances computed) of points (d x n) seen for the first time."""
    n, k = x.shape[1], len(centers)
    own, upper, lower = np.empty(n, np.int32), np.empty(n), np.empty(n)
    step = max(1, (1 << 20) // max(k, 1))
    for a in range(0, n, step):
        own[a : a + step], upper[a : a + step], lower[a : a + step] = _two_least(exact(x[:, a : a + step], centers), np.arange(k))
    if not np.isfinite(upper).all():
        raise ValueError(BAD_POINT)
    return own, upper, lower, np.full(n, k)


def next_bounds(x: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray, moved: np.ndarray, near: Neighbourhood) -> tuple[np.ndarray, ...]:
    """The same after the centers moved by ``moved`` each, to those of ``near``."""
    centers, k = near.centers, len(near.centers)
    order = np.argsort(moved)
    far, second = order[-1], (order[-2] if k > 1 else order[-1])
    computed = np.zeros(len(own), np.int64)
    upper = upper + moved[own]
    lower = lower - np.where(own == far, moved[second], moved[far])
    if k == 1:
        return own, upper, lower, computed
    half = near.dist[own, 0] / 2
    safe = lambda u, floor: u * (1 + SLACK) < floor * (1 - SLACK)
    ask = np.flatnonzero(~safe(upper, np.maximum(lower, half)))
    diff = np.zeros(len(ask))
    for column, value in zip(x[:, ask], centers[own[ask]].T):
        diff += (column - value) ** 2
    upper[ask] = np.sqrt(diff)
    computed[ask] += 1
    ask = ask[~safe(upper[ask], np.maximum(lower[ask], half[ask]))]
    own = own.copy()
    for c in np.unique(own[ask]):
        points = ask[own[ask] == c]
        reach = 2 * upper[points] * (1 + SLACK)
        counts = np.searchsorted(near.dist[c], reach, side="right")
        # Beyond the list there may be more centers within reach.
        everyone = (counts == near.dist.shape[1]) & (near.dist.shape[1] < k - 1)
        if everyone.any():
            some = points[everyone]
            own[some], upper[some], lower[some], more = first_bounds(x[:, some], centers)
            computed[some] += more
        some, m = points[~everyone], counts[~everyone]
        if len(some):
            most = int(m.max())
            ids = np.concatenate([[c], near.order[c, :most]])
            # Centers beyond the list are at least this far from the points.
            beyond = near.dist[c, most] - upper[some] if most < near.dist.shape[1] else np.full(len(some), np.inf)
            found, least, rest = _two_least(exact(x[:, some], centers[ids]), ids)
            computed[some] += len(ids)
            own[some], upper[some], lower[some] = found, least, np.minimum(rest, beyond)
    return own, upper, lower, computed


def _batches(features: str, d: int, step):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = step(coordinates([batch.column(features)], d), batch)
                columns = [pa.array(a, t) for a, t in zip(found, (pa.int32(), pa.float64(), pa.float64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column(features), *columns], [features, "cluster_id", "upper", "lower", "computed"])

    return run


def bounded_assignment(points: DataFrame, centers: Sequence[Sequence[float]] | np.ndarray, features: str = "features") -> DataFrame:
    """(features, cluster_id, upper, lower, computed): the nearest centers with first bounds."""
    table = as_centers(centers)
    frame = points.select(F.col(features).cast("array<double>").alias(features))
    run = _batches(features, table.shape[1], lambda x, _: first_bounds(x, table))
    return frame.mapInArrow(run, f"{features} array<double>, {STATE}")


def moved_assignment(state: DataFrame, before: np.ndarray, after: np.ndarray, features: str = "features") -> DataFrame:
    """The state after the centers moved; ``computed`` counts the distances that this took per point."""
    old, new = as_centers(before), as_centers(after)
    moved, near = np.sqrt(((new - old) ** 2).sum(axis=1)), Neighbourhood.of(new)
    column = lambda batch, name: batch.column(name).to_numpy(zero_copy_only=False)

    def step(x: np.ndarray, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        return next_bounds(x, column(batch, "cluster_id"), column(batch, "upper"), column(batch, "lower"), moved, near)

    return state.mapInArrow(_batches(features, new.shape[1], step), f"{features} array<double>, {STATE}")


@dataclass(frozen=True)
class BoundedRun:
    """Centers after the rounds, the points with their last assignment to them, and the work done."""

    centers: np.ndarray
    state: DataFrame
    computed: list[int]  # distances of each round
    full: int  # distances of a round without bounds


def bounded_kmeans(
    points: DataFrame, init: Sequence[Sequence[float]] | np.ndarray, max_iter: int, features: str = "features", tol: float = 1e-4
) -> BoundedRun:
    """Lloyd rounds from ``init`` with the same centers and assignments as ``kmeans``.

    The points are written with their bounds once a round, so no lineage grows and a lost task reads
    its own part again. A center without points stays. Worth it from some hundred centers on.
    """
    if max_iter < 0:
        raise ValueError("max_iter must not be negative")
    centers = as_centers(init)
    state = written(bounded_assignment(points, centers, features), "bounds")
    vector = array_to_vector(F.col(features))
    computed, n = [], None
    for turn in range(max_iter + 1):
        # At most k rows.
        rows = state.groupBy("cluster_id").agg(
            Summarizer.mean(vector).alias("m"), F.count(F.lit(1)).alias("n"), F.sum("computed").alias("c")
        ).collect()
        n = sum(r["n"] for r in rows)
        computed.append(sum(r["c"] for r in rows))
        if turn == max_iter:
            break
        before, centers = centers, centers.copy()
        for row in rows:
            centers[row["cluster_id"]] = row["m"].toArray()
        state = written(moved_assignment(state, before, centers, features), "bounds")
        if (((centers - before) ** 2).sum(axis=1) <= tol**2).all():
            computed.append(state.agg(F.sum("computed")).first()[0] or 0)
            break
    return BoundedRun(centers, state, computed, (n or 0) * len(centers))
