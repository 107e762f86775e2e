"""Numpy helpers that tasks apply to one Arrow batch."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Tasks get these functions with the query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BAD_POINT = "point of wrong dimension or with a missing or non-finite coordinate"


def coordinates(arrays: list[pa.Array], d: int) -> np.ndarray:
    """d x n coordinates of a batch; raises on any malformed point.

    Takes one array per coordinate, or a single array of coordinate lists.
    """
    arrays = [a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays]
    if any(a.null_count for a in arrays):
        raise ValueError(BAD_POINT)
    if not pa.types.is_list(arrays[0].type):
        return np.stack([a.to_numpy(zero_copy_only=False) for a in arrays])
    flat = arrays[0].flatten()
    sizes = arrays[0].value_lengths().to_numpy(zero_copy_only=False)
    if flat.null_count or (sizes != d).any():
        raise ValueError(BAD_POINT)
    return np.ascontiguousarray(flat.to_numpy(zero_copy_only=False).reshape(-1, d).T)


def nearest_in_batch(columns: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest center for each of n points (d x n).

    Sums (x - c)^2 one coordinate after the other, as the column form does, so both give
    the same doubles and the same ties.
    """
    n = columns.shape[1]
    best = np.full(n, np.inf)
    index = np.zeros(n, dtype=np.int32)
    dist, diff = np.empty(n), np.empty(n)
    for i, center in enumerate(centers):
        dist.fill(0.0)
        for column, value in zip(columns, center):
            np.subtract(column, value, out=diff)
            np.multiply(diff, diff, out=diff)
            np.add(dist, diff, out=dist)
        closer = dist < best
        np.copyto(best, dist, where=closer)
        np.copyto(index, i, where=closer, casting="unsafe")
    if not np.isfinite(best).all():
        raise ValueError(BAD_POINT)
    return index, best


def merged_moments(x: tuple, y: tuple) -> tuple:
    """(n, mean, ss) of two disjoint sets of points together; no difference of large sums."""
    n = x[0] + y[0]
    apart = y[1] - x[1]
    mean = x[1] + apart * (y[0] / n)
    return n, mean, x[2] + y[2] + float(apart @ apart) * (x[0] * y[0] / n)


def add_moments(n: np.ndarray, mean: np.ndarray, ss: np.ndarray, slot: np.ndarray, x: np.ndarray) -> None:
    """Merges the points of a batch (d x points, each with a slot) into count, mean and scatter per slot."""
    slots = len(n)
    own = np.bincount(slot, minlength=slots)
    used = np.flatnonzero(own)
    # Shifted by a point of the slot, so that sums stay small for points far from the origin.
    first = np.full(slots, -1)
    first[slot[::-1]] = np.arange(len(slot))[::-1]
    origin = np.zeros((slots, len(x)))
    origin[used] = x[:, first[used]].T
    center = origin.copy()
    for j, column in enumerate(x):
        shifted = np.bincount(slot, weights=column - origin[slot, j], minlength=slots)
        center[used, j] += shifted[used] / own[used]
    scatter = np.zeros(slots)
    for j, column in enumerate(x):
        scatter += np.bincount(slot, weights=(column - center[slot, j]) ** 2, minlength=slots)
    total = n + own
    apart = center - mean
    share = np.divide(own, total, out=np.zeros(slots), where=total > 0)
    ss += scatter + (apart**2).sum(axis=1) * n * share
    mean += apart * share[:, None]
    n += own
