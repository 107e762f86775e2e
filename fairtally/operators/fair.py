"""Socially fair k-means: minimise the larger of the two group objectives.

Follows the published fair Lloyd method (Ghadiri, Samadi, Vempala 2021). Each round is
one Spark aggregate over the points; the driver then solves for the new centers on at
most 2K rows of statistics.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from fairtally.functions.centers import as_centers
from fairtally.operators.groups import group_stats
from fairtally.operators.objectives import TWO_GROUPS, Centers
from fairtally.operators.rounds import Round, RoundLog, exact_numbers
from fairtally.operators.start import start_centers
from fairtally.storage import held

# The search starts at weight 1/2, its first move is 1/4, every further move
# is half of the one before, and it looks at ten weights.
START_WEIGHT = 0.5
FIRST_MOVE = 0.25
WEIGHTS_TRIED = 10


@dataclass(frozen=True)
class FairStep:
    """What one fair Lloyd round computed."""

    centers: np.ndarray
    gamma: float
    f_a: float
    f_b: float
    x: np.ndarray
    alpha: np.ndarray
    beta: np.ndarray
    ell: np.ndarray


def balance(
    fixed: tuple[float, float], alpha: np.ndarray, beta: np.ndarray, ell: np.ndarray
) -> tuple[float, np.ndarray, float, float]:
    """(gamma, x, f_a, f_b): how far to move each center from its A towards its B centroid.

    The answer belongs to the last weight that was evaluated, not to the one the search
    would have tried next.
    """
    gamma, move = START_WEIGHT, FIRST_MOVE
    for left in reversed(range(WEIGHTS_TRIED)):
        pull_a, pull_b = gamma * alpha, (1.0 - gamma) * beta
        both = pull_a + pull_b
        x = np.divide(pull_b * ell, both, out=np.zeros_like(ell), where=both > 0)
        f_a = fixed[0] + float(alpha @ x**2)
        f_b = fixed[1] + float(beta @ (ell - x) ** 2)
        if left == 0 or f_a == f_b:
            break
        gamma += move if f_a > f_b else -move
        move /= 2
    return gamma, x, f_a, f_b


def fair_step(
    points: DataFrame,
    centers: Centers,
    groups: tuple[str, str] = TWO_GROUPS,
    features: str = "features",
    grp: str = "grp",
) -> FairStep:
    """One round: assign, summarise both groups per cluster, balance, move the centers."""
    if len(groups) != 2:
        raise ValueError("fair k-means balances exactly two groups")
    table = as_centers(centers)
    k, d = table.shape
    count = np.zeros((2, k))
    ss = np.zeros(2)
    mean = np.full((2, k, d), np.nan)
    for row in group_stats(points, table, groups, features, grp).collect():  # at most 2K rows
        count[row.g, row.cluster_id] = row.n
        mean[row.g, row.cluster_id] = row.mean
        ss[row.g] += row.ss
    size = count.sum(axis=1)
    for name, n in zip(groups, size):
        if n == 0:
            raise ValueError(f"no points in group {name}")

    # A group that is missing in a cluster borrows the other centroid; a cluster without
    # any point keeps its center.
    mean_a = np.where(np.isnan(mean[0]), mean[1], mean[0])
    mean_b = np.where(np.isnan(mean[1]), mean[0], mean[1])
    mean_a = np.where(np.isnan(mean_a), table, mean_a)
    mean_b = np.where(np.isnan(mean_b), table, mean_b)
    alpha, beta = count[0] / size[0], count[1] / size[1]
    ell = np.sqrt(((mean_a - mean_b) ** 2).sum(axis=1))
    gamma, x, f_a, f_b = balance((ss[0] / size[0], ss[1] / size[1]), alpha, beta, ell)

    apart = ell > 0
    share_b = np.divide(x, ell, out=np.zeros(k), where=apart)[:, None]
    moved = np.where(apart[:, None], (1.0 - share_b) * mean_a + share_b * mean_b, mean_a)
    return FairStep(moved, gamma, f_a, f_b, x, alpha, beta, ell)


def fair_kmeans(
    points: DataFrame,
    k: int,
    max_iter: int,
    init: Centers | None = None,
    seed: int = 1,
    groups: tuple[str, str] = TWO_GROUPS,
    features: str = "features",
    grp: str = "grp",
    cache: bool = True,
    ids: Sequence[str] | None = None,
    log: str | None = None,
) -> np.ndarray:
    """Fair centers after exactly ``max_iter`` rounds.

    ``init`` gives the start centers and makes the result deterministic; otherwise a seeded
    k-means|| start is used. ``cache`` keeps the two needed columns in memory and on disk
    over the rounds; switch it off for columnar tables that are cheaper to scan again.

    ``log`` names a folder where every round is written. A run that finds rounds of the same job
    there goes on after the last of them, from the very centers; another job's log is refused.
    """
    if k < 1 or max_iter < 0:
        raise ValueError("k must be positive and max_iter not negative")
    needed = points.select(*(ids or []), features, grp)
    if needed.limit(k).count() < k:
        warnings.warn(f"fewer points than k = {k}", stacklevel=2)
    given = None if init is None else as_centers(init)
    rounds = None
    if log:
        job = {"k": k, "seed": seed, "groups": list(groups), "features": features, "grp": grp, "init": exact_numbers(given)}
        rounds = RoundLog(points.sparkSession, log, job)
    done = rounds.last(max_iter) if rounds else None
    if done and done.number == max_iter:
        return done.centers
    with held(needed, cache) as rows:
        if done:
            turn, centers = done.number, done.centers
        else:
            turn, centers = 0, given if given is not None else start_centers(rows, k, seed, features, ids)
            if rounds:
                rounds.append(Round(0, centers))
        while turn < max_iter:
            step = fair_step(rows, centers, groups, features, grp)
            turn, centers = turn + 1, step.centers
            if rounds:
                rounds.append(Round(turn, centers, {"gamma": step.gamma, "f_a": step.f_a, "f_b": step.f_b}))
        return centers
