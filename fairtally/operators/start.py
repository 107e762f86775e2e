"""Start centers by k-means||: rounds of picks in proportion to cost, then a weighted reduction.

A point's luck in a round is a hash of its id, the seed and the round. The points of least luck divided by
cost are picked (sequential Poisson sampling): a fixed number in each round, in one scan, without the
total cost, and the same ones however the points are partitioned.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairtally.operators.nearest import with_nearest

ROUNDS = 2
PICKS_PER_CENTER = 2
TRIES, POLISH = 8, 30
HEX_DIGITS = 13  # 52 bits: a double holds them all


def luck(key: Column, seed: int, turn: int) -> Column:
    """A number in [0, 1) for each key, seed and round: the first 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(key, F.lit(f":{seed}:{turn}")).cast("binary"))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("bigint") / F.lit(float(16**HEX_DIGITS))


def _keyed(points: DataFrame, features: str, ids: Sequence[str] | None) -> DataFrame:
    """(key, x, w): the points by id; without ids, equal points are one of that weight."""
    x = F.col(features).cast("array<double>")
    if ids:
        return points.select(F.concat_ws("|", *[F.col(c).cast("string") for c in ids]).alias("key"), x.alias("x"), F.lit(1).cast("bigint").alias("w"))
    # Adding 0 makes -0.0 and 0.0 one value.
    plain = points.select(F.transform(x, lambda v: v + F.lit(0.0)).alias("x"))
    return plain.groupBy("x").agg(F.count(F.lit(1)).alias("w")).select(F.col("x").cast("string").alias("key"), "x", "w")


def cost_picks(keyed: DataFrame, centers: np.ndarray, n: int, seed: int, turn: int) -> DataFrame:
    """The ``n`` rows of (key, x, w) with the least luck divided by weight and distance, most likely far ones.

    Points at a center are never picked. The result is at most n rows; tasks keep n each.
    """
    near = with_nearest(keyed, centers, "x").where(F.col("dist") > 0)
    rank = luck(F.col("key"), seed, turn) / (F.col("w") * F.col("dist"))
    return near.select("key", "x", "w", rank.alias("rank")).orderBy("rank", "key").limit(n)


def _square(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)


def reduce_weighted(x: np.ndarray, w: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k centers of weighted points: the best of several k-means++ starts after Lloyd rounds, on the driver."""
    rng = np.random.default_rng(seed)
    best, least = x[:k], np.inf
    for _ in range(TRIES):
        centers = x[[rng.choice(len(x), p=w / w.sum())]]
        dist = _square(x, centers)[:, 0]
        while len(centers) < k:
            mass = w * dist
            if not mass.sum():
                mass = np.where(dist > 0, 1.0, 0.0) + 1e-300
            centers = np.vstack([centers, x[rng.choice(len(x), p=mass / mass.sum())]])
            dist = np.minimum(dist, _square(x, centers[-1:])[:, 0])
        for _ in range(POLISH):
            near = np.concatenate([_square(part, centers).argmin(axis=1) for part in np.array_split(x, len(x) // 512 + 1)])
            mass = np.bincount(near, w, k)
            sums = np.stack([np.bincount(near, w * column, k) for column in x.T], axis=1)
            moved = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-300)[:, None], centers)
            if np.array_equal(moved, centers):
                break
            centers = moved
        cost = float((w * np.concatenate([_square(p, centers).min(axis=1) for p in np.array_split(x, len(x) // 512 + 1)])).sum())
        if cost < least:
            best, least = centers, cost
    return best


def start_centers(
    points: DataFrame,
    k: int,
    seed: int = 1,
    features: str = "features",
    ids: Sequence[str] | None = None,
    rounds: int = ROUNDS,
    per_center: int = PICKS_PER_CENTER,
) -> np.ndarray:
    """Up to k start centers: one scan for the first, one per round, one for the weights.

    ``ids`` names columns that tell points apart; without them equal points are grouped first, which
    shuffles the points once. At most 1 + rounds * per_center * k candidates reach the driver. Fewer
    distinct points than ``k`` are the centers themselves, with a warning.
    """
    if k < 1:
        raise ValueError("k must be positive")
    keyed = _keyed(points, features, ids)
    first = keyed.agg(F.min(F.struct(luck(F.col("key"), seed, 0).alias("u"), "key", "x")).alias("m")).first()["m"]
    if first is None:
        raise ValueError("no points")
    found = np.array([first["x"]], dtype=np.float64)
    if k == 1:
        return found  # the point of least luck
    turn = 0
    while turn < rounds or len(found) < k:
        turn += 1
        rows = cost_picks(keyed, found, per_center * k, seed, turn).collect()
        if not rows:
            break
        found = np.vstack([found, np.unique(np.array([r["x"] for r in rows], dtype=np.float64), axis=0)])
    if len(found) <= k:
        if len(found) < k:
            warnings.warn(f"only {len(found)} of {k} centers found", stacklevel=2)
        return found
    weight = np.zeros(len(found))
    for row in with_nearest(keyed, found, "x").groupBy("cluster_id").agg(F.sum("w").alias("n")).collect():
        weight[row["cluster_id"]] = row["n"]
    return reduce_weighted(found[weight > 0], weight[weight > 0], k, seed) if (weight > 0).sum() >= k else found[:k]
